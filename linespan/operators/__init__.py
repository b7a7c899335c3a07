"""DataFrame operators that build and check the timetable warehouse."""
