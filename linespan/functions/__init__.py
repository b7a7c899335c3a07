"""Column functions shared by every operator."""
