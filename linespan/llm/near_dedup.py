"""Near-duplicate documents by SetSketch registers.

A document's set holds the distinct five-word shingles. Its sketch has
registers K = floor(1 - log_b(min of exponential values over the set)),
truncated to 16 bits; the maximum of two sketches is the sketch of the union.

1. Documents with equal sets form a class, counted before the shuffle; one
   representative goes on, so groups of copies cost nothing further. A filter of the
   other rows spares the sketches of representatives the move.
2. Bands of registers are hashed. A filter of the hashes seen twice leaves out most
   bands that stand alone before any is moved. Each band bucket links its members to the
   bucket's first member by a fixed random order: as many candidates as members.
3. A joint likelihood estimate from the registers (how many are larger,
   smaller, equal, with both set sizes known) drops candidates that are
   ``DEVIATIONS`` standard errors below the threshold. The rest are verified on
   the full sets.
4. Buckets that still hold more than one component are finished exactly: inside
   blocks of bounded size every pair of different components is estimated,
   and verified on full sets until the components merge. Large buckets are cut
   into pairs of blocks. So no link between different components is lost, while
   only links that join components leave a task.
5. Components are found by star contractions on written links.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased. With fewer words
than a shingle has, the whole sequence is one shingle; without words the set is
empty and linked with nothing. Repeated rows are linked like copies. Null
identifiers come last and only name a component that has no other. Very long
texts are used whole. An empty table gives no rows. Only the named columns are
read, so further columns cannot clash. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linespan.llm import bloom
from linespan.llm.common import CODEC, discard, keyed, settle, tidy, whole_rows
from linespan.llm.components import components

SHINGLE = 5
PERCENT = 85
ROWS = 5
BANDS = 32
# Sketch parameters: base, rate and the largest register value.
BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 2
DEVIATIONS = 5
# Shingles of one block of a bucket.
BLOCK_SHINGLES = 2_000_000
# Registers compared at a time, and probes of the filter of wanted nodes.
PAIR_CELLS = 4_000_000
FILTER_PROBES = 4
# Filter of band keys: with these, 1.4 % of the keys that stand alone pass.
BAND_PROBES, BITS_PER_BAND = 2, 16
REMEMBERED_WORDS = 250_000

_RANDOM = np.random.Generator(np.random.PCG64(20_240_607))
MULTIPLIERS = _RANDOM.integers(1, 2**63, 512, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _RANDOM.integers(0, 2**63, 512, dtype=np.uint64)
POWER = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash of a word; forgets all words when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every window of ``length`` consecutive word hashes."""
    rolled = hashes[: len(hashes) - length + 1].copy()
    for k in range(1, length):
        rolled *= POWER
        rolled += hashes[k : len(hashes) - length + 1 + k]
    return mixed(rolled)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of a document."""
    if not len(words):
        return words
    if len(words) < SHINGLE:
        return windows(words, len(words)) ^ np.uint64(len(words))
    return np.unique(windows(words, SHINGLE))


def registers(shingles: np.ndarray, count: int) -> np.ndarray:
    """The sketch: truncated logarithms of exponential minima."""
    least = np.full(count, np.uint64(2**64 - 1))
    for start in range(0, len(shingles), 256):
        part = shingles[start : start + 256, None]
        np.minimum(least, (part * MULTIPLIERS[:count] + OFFSETS[:count]).min(axis=0), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    value = np.floor(1 - np.log(-np.log1p(-uniform) / RATE) / math.log(BASE))
    return np.clip(value, 0, LIMIT + 1).astype(np.uint16)


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of registers."""
    bands = sketch.reshape(-1, rows).astype(np.uint64)
    total = (bands * MULTIPLIERS[:rows]).sum(axis=1, dtype=np.uint64)
    return mixed(total + OFFSETS[: len(bands)]).view(np.int64)


def likely_jaccard(equal: np.ndarray, larger: np.ndarray, smaller: np.ndarray, size_u, size_v) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches.

    With u and v the shares of the set sizes, a register of the first exceeds
    that of the second with probability p(u - vJ), is exceeded with p(v - uJ),
    p(x) = -log_b(1 - x (b - 1) / b). The likelihood is unimodal in J.
    """
    size_u, size_v = np.asarray(size_u, np.float64), np.asarray(size_v, np.float64)
    u, v = size_u / (size_u + size_v), size_v / (size_u + size_v)

    def chance(x):
        return np.maximum(-np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / math.log(BASE), 1e-12)

    def likelihood(j):
        more, less = chance(u - v * j), chance(v - u * j)
        return larger * np.log(more) + smaller * np.log(less) + equal * np.log(np.maximum(1 - more - less, 1e-12))

    low, high = np.zeros_like(u), np.minimum(u / v, v / u)
    for _ in range(30):
        third = (high - low) / 3
        better = likelihood(low + third) < likelihood(high - third)
        low = np.where(better, low + third, low)
        high = np.where(better, high, high - third)
    return (low + high) / 2


def least_estimate(percent: int, count: int) -> float:
    """Estimates below this belong to pairs below the threshold, all but surely."""
    j = percent / 100
    return j - DEVIATIONS * math.sqrt(j * (1 - j) / count)


def sketched(stored: DataFrame, rows: int, bands: int) -> DataFrame:
    """Return row_key, id, n_shingles, set_key, sketch per row of (row_key, id, text)."""
    kind = stored.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sizes, keys, sketches = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                shingles = shingle_set(known.of((text or b"").lower().split()))
                sizes.append(len(shingles))
                keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                sketches.append(registers(shingles, rows * bands).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_key"), batch.column("id"), pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()), pa.array(sketches, pa.binary()),
                ],
                names=["row_key", "id", "n_shingles", "set_key", "sketch"],
            )

    return stored.select("row_key", "id", "text").mapInArrow(
        tidy(run), f"row_key long, id {kind}, n_shingles long, set_key binary, sketch binary"
    )


def _keys_by_band(batch: pa.RecordBatch, rows: int, numbers: range) -> np.ndarray:
    """Band keys of a batch of representatives, one row each, for the bands ``numbers``."""
    sketches = [np.frombuffer(s, np.uint16) for s in batch.column("sketch").to_pylist()]
    keys = [band_keys(s, rows)[numbers.start : numbers.stop] for s in sketches]
    return np.stack(keys) if keys else np.zeros((0, len(numbers)), np.int64)


def _repeated(representatives: DataFrame, rows: int, numbers: range, bits: int) -> DataFrame:
    """Band rows whose key was perhaps seen twice: band, number (of the band), node, size."""

    def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [mixed(_keys_by_band(batch, rows, numbers).view(np.uint64).ravel()) for batch in batches]
        yield from bloom.seen(found, bits, BAND_PROBES)

    view = representatives.select("node", "size", "sketch")
    filters = settle(bloom.merged(view.mapInArrow(tidy(insert), bloom.PAYLOAD)), "near-band-filter")
    twice = representatives.sparkSession.sparkContext.broadcast(bloom.gathered(filters, "twice", bits))
    discard(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _keys_by_band(batch, rows, numbers)
            hit = bloom.contains(twice.value, mixed(keys.view(np.uint64).ravel()), bits, BAND_PROBES)
            at, place = np.nonzero(hit.reshape(keys.shape))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[at, place], pa.int64()), pa.array(place + numbers.start, pa.int32()),
                    batch.column("node").take(pa.array(at)), batch.column("size").take(pa.array(at)),
                ],
                names=["band", "number", "node", "size"],
            )

    return settle(view.mapInArrow(tidy(run), "band long, number int, node long, size long"), "near-bands")


def repeated_bands(representatives: DataFrame, rows: int, bands: int, most_bits: int = bloom.MOST_BITS) -> list[DataFrame]:
    """Band rows that may share their bucket with another representative, in written tables.

    A filter of band keys seen twice keeps the others, nearly all, from being moved. When
    one filter of ``most_bits`` cannot hold the keys of all bands, bands are worked
    through in ranges, one filter after the other.
    """
    wanted = max(1, representatives.count()) * BITS_PER_BAND
    at_once = max(1, min(bands, most_bits // wanted))
    return [
        _repeated(
            representatives, rows, range(first, min(first + at_once, bands)),
            bloom.filter_bits(wanted * min(at_once, bands - first)),
        )
        for first in range(0, bands, at_once)
    ]


def _estimated(pairs: DataFrame, least: float) -> DataFrame:
    """Pairs whose likelihood estimate does not rule them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a = np.stack([np.frombuffer(s, np.uint16) for s in batch.column("sketch_u").to_pylist()])
            b = np.stack([np.frombuffer(s, np.uint16) for s in batch.column("sketch_v").to_pylist()])
            guess = likely_jaccard(
                (a == b).sum(1), (a > b).sum(1), (a < b).sum(1),
                batch.column("size_u").to_numpy(), batch.column("size_v").to_numpy(),
            )
            keep = pa.array(guess >= least)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("u", "v")], names=["u", "v"])

    return pairs.mapInArrow(tidy(run), "u long, v long")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    place = np.searchsorted(b, a)
    shared = int((b[np.minimum(place, len(b) - 1)] == a).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _verified(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                _similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent)
                for a, b in zip(batch.column("set_u").to_pylist(), batch.column("set_v").to_pylist(), strict=True)
            ]
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("u", "v")], names=["u", "v"])

    return pairs.mapInArrow(tidy(run), "u long, v long")


def _with_both(pairs: DataFrame, values: DataFrame, names: list[str]) -> DataFrame:
    """Join columns of ``values`` (node, ...) to both ends of the pairs."""
    for end in ("u", "v"):
        side = values.select(F.col("node").alias(end), *(F.col(n).alias(f"{n}_{end}") for n in names))
        pairs = pairs.join(side, end)
    return pairs


class _Nodes:
    """A set of nodes, tested by a Bloom filter where rows are read and exactly by a join after it."""

    def __init__(self, nodes: DataFrame) -> None:
        self.wanted = settle(nodes.select("node").distinct(), "near-wanted")
        self.bits = bits = bloom.filter_bits(self.wanted.count() * 16)

        def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = [mixed(batch.column("node").to_numpy().view(np.uint64)) for batch in batches]
            yield from bloom.seen(found, bits, FILTER_PROBES)

        filters = settle(bloom.merged(self.wanted.mapInArrow(tidy(insert), bloom.PAYLOAD)), "near-filter")
        self.filter = nodes.sparkSession.sparkContext.broadcast(bloom.gathered(filters, "once", bits))
        discard(filters)

    def others(self, table: DataFrame, purpose: str) -> DataFrame:
        """Write the rows of ``table`` whose node is not in the set; only those that hit the filter are moved."""
        shared, bits = self.filter, self.bits

        def passing(hit: bool) -> DataFrame:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    keys = mixed(batch.column("node").to_numpy().view(np.uint64))
                    yield batch.filter(pa.array(bloom.contains(shared.value, keys, bits, FILTER_PROBES) == hit))

            return table.mapInArrow(tidy(run), table.schema)

        return settle(
            passing(False).unionByName(passing(True).join(self.wanted, "node", "left_anti")), purpose
        )

    def rows(self, table: DataFrame, column: str, make, schema: str, purpose: str) -> DataFrame:
        """Write what ``make`` gives for the batches of rows of ``table`` whose node is in the set."""
        shared, bits = self.filter, self.bits

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = make()
            for batch in batches:
                keys = mixed(batch.column(column).to_numpy().view(np.uint64))
                yield held(batch.filter(pa.array(bloom.contains(shared.value, keys, bits, FILTER_PROBES))))

        found = settle(
            table.mapInArrow(tidy(run), schema).join(self.wanted, "node", "left_semi"), purpose
        )
        return found


def _sketches(representatives: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, size and sketch of some nodes, so that the sketches of the others are not moved."""
    members = _Nodes(nodes)
    found = members.rows(
        representatives.select("node", "size", "sketch"), "node", lambda: lambda batch: batch,
        "node long, size long, sketch binary", "near-some-sketches",
    )
    discard(members.wanted)
    return found


def _representatives(all_sketches: DataFrame, classes: DataFrame) -> DataFrame:
    """node, size and sketch of the first row of every class.

    Rows without copies stay where they are: a join of all rows with the first rows
    would move every sketch as soon as the classes are too many to broadcast.
    """
    table = all_sketches.where("n_shingles > 0").select(
        F.col("row_key").alias("node"), F.col("n_shingles").alias("size"), "sketch"
    )
    heads = classes.select(F.col("head.row_key").alias("node"))
    copies = _Nodes(table.select("node").join(heads, "node", "left_anti"))
    found = copies.others(table, "near-representatives")
    discard(copies.wanted)
    return found


def _full_sets(stored: DataFrame, nodes: DataFrame, purpose: str) -> DataFrame:
    """node and its full set, as packed 64-bit hashes: sets are moved and texts are not."""
    members = _Nodes(nodes)

    def make():
        known = WordHashes()

        def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
            packed = [
                shingle_set(known.of((text or b"").lower().split())).tobytes()
                for text in batch.column("text").cast(pa.binary()).to_pylist()
            ]
            return pa.RecordBatch.from_arrays(
                [batch.column("row_key"), pa.array(packed, pa.binary())], names=["node", "set"]
            )

        return sets

    found = members.rows(stored.select("row_key", "text"), "row_key", make, "node long, set binary", purpose)
    discard(members.wanted)
    return found


class _Union:
    """Union-find over the components of one block."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = self.parent.get(up, up)
            x = up
        return x

    def join(self, a: int, b: int) -> None:
        self.parent[max(a, b)] = min(a, b)


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from batches sorted by the keys."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(name).to_numpy() for name in names]
        changed = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        bounds = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for begin, end in zip(bounds, bounds[1:], strict=False):
            own = tuple(c[begin] for c in columns)
            if own != key and held:
                yield pa.Table.from_batches(held)
                held = []
            key = own
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


def _open_pairs(group: pa.Table, least: float, rows: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs of a block pair that differ in component and may be similar.

    The likeliest pairs come first. A pair that already met in an earlier band
    is left to that band.
    """
    column = lambda name: group.column(name).to_numpy()
    sketch = np.stack([np.frombuffer(s, np.uint16) for s in group.column("sketch").to_pylist()])
    size, part, own = column("size"), column("component"), column("block")
    low, high, number = column("low")[0], column("high")[0], int(column("number")[0])
    first, second = np.flatnonzero(own == low), np.flatnonzero(own == high)
    none = np.zeros(0, np.int64)
    if not len(first) or not len(second):
        return none, none
    # Registers agree at least about as often as the sets do.
    enough = (least - 0.1) * sketch.shape[1]
    step = max(1, PAIR_CELLS // max(1, sketch.shape[1] * len(second)))
    found = []
    for start in range(0, len(first), step):
        chunk = first[start : start + step]
        same = (sketch[chunk][:, None, :] == sketch[second][None, :, :]).sum(2)
        fits = (same >= enough) & (part[chunk][:, None] != part[second][None, :])
        small = np.minimum(size[chunk][:, None], size[second][None, :])
        big = np.maximum(size[chunk][:, None], size[second][None, :])
        fits &= 100 * small >= percent * big
        if low == high:
            fits &= chunk[:, None] < second[None, :]
        i, j = np.nonzero(fits)
        found.append((chunk[i], second[j], same[i, j]))
    left, right, same = (np.concatenate(x) for x in zip(*found, strict=True))
    if number and len(left):
        before = slice(0, number * rows)
        met = (sketch[left, before] == sketch[right, before]).reshape(len(left), number, rows).all(2).any(1)
        left, right, same = left[~met], right[~met], same[~met]
    if not len(left):
        return left, right
    larger = (sketch[left] > sketch[right]).sum(1)
    guess = likely_jaccard(same, larger, sketch.shape[1] - same - larger, size[left], size[right])
    order = np.argsort(-guess, kind="stable")
    order = order[guess[order] >= least]
    return left[order], right[order]


GROUP = ("band", "low", "high")
MEMBER = "band long, number int, node long, size long, component long, block int, low int, high int"
MEMBER_NAMES = tuple(x.split()[0] for x in MEMBER.split(", "))


def _by_group(rows: DataFrame) -> DataFrame:
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP, "node")


def _finish(
    buckets: DataFrame, labels: DataFrame, sketches: DataFrame, stored: DataFrame, *, least: float, rows: int,
    percent: int, block_shingles: int,
) -> DataFrame:
    """Links between different components that share a bucket.

    ``buckets``: band, number, node, size, leader. ``labels``: node, component.
    The leader has been compared with every member, so it stays out. Buckets of
    one member set are looked at once, in their earliest band.
    """
    named = (
        buckets.where("node <> leader").join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    several = (
        named.groupBy("band")
        .agg(
            F.min("component").alias("a"), F.max("component").alias("b"), F.sum("size").alias("shingles"),
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("members"),
            F.min("number").alias("number"),
        )
        .where("a <> b")
    )
    different = several.groupBy("members", "n", "shingles").agg(
        F.min_by("band", F.struct("number", "band")).alias("band")
    ).select("band", F.ceil(F.col("shingles") / block_shingles).cast("int").alias("blocks"))
    members = named.join(different, "band").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    # A member goes to every pair of blocks that has its own block.
    dealt = settle(
        members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "band", "number", "node", "size", "component", "block",
            F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        ),
        "near-blocks",
    )

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for group in _groups(batches, GROUP):
            kept = np.unique(np.concatenate(_open_pairs(group, least, rows, percent)))
            if len(kept):
                held.append(group.select(MEMBER_NAMES).take(pa.array(kept)))
            if len(held) >= 500:
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held = []
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    some = _sketches(sketches, dealt)
    own = some.select("node", "sketch")
    open_members = settle(_by_group(dealt.join(own, "node")).mapInArrow(tidy(survivors), MEMBER), "near-open")
    discard(dealt)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = []
        for group in _groups(batches, GROUP):
            sets = [np.frombuffer(s, np.uint64) for s in group.column("set").to_pylist()]
            part, node = group.column("component").to_pylist(), group.column("node").to_pylist()
            merged = _Union()
            for i, j in zip(*(x.tolist() for x in _open_pairs(group, least, rows, percent)), strict=True):
                a, b = merged.find(part[i]), merged.find(part[j])
                if a != b and _similar(sets[i], sets[j], percent):
                    merged.join(a, b)
                    links.append((node[i], node[j]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["u", "v"]
        )

    sets = _full_sets(stored, open_members, "near-open-sets")
    links = settle(
        _by_group(open_members.join(own, "node").join(sets, "node")).mapInArrow(tidy(verify), "u long, v long"),
        "near-more-links",
    )
    discard(open_members, sets, some)
    return links


def near_groups(
    stored: DataFrame, *, percent: int = PERCENT, rows: int = ROWS, bands: int = BANDS,
    block_shingles: int = BLOCK_SHINGLES, most_bits: int = bloom.MOST_BITS,
) -> DataFrame:
    """Return row_key, id, n_shingles, component_id, head (the row that names the component).

    ``stored``: row_key (different in every row), id, text; read several times,
    so it must be a written table.
    """
    least = least_estimate(percent, rows * bands)
    all_sketches = settle(sketched(stored, rows, bands), "near-sketches")
    all_rows = settle(all_sketches.drop("sketch"), "near-rows")
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "row_key")
    classes = settle(
        all_rows.where("n_shingles > 0").groupBy("set_key").agg(F.min(rank).alias("head")), "near-classes"
    )
    representatives = _representatives(all_sketches, classes)
    discard(all_sketches)
    band_tables = repeated_bands(representatives, rows, bands, most_bits)
    bucketed = reduce(DataFrame.unionByName, band_tables)
    order = F.struct(F.xxhash64("node").alias("draw"), F.col("node").alias("leader"))
    leaders = (
        bucketed.groupBy("band")
        .agg(F.min(order).getField("leader").alias("leader"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("band", "leader")
    )
    buckets = settle(bucketed.join(leaders, "band"), "near-buckets")
    discard(*band_tables)
    pairs = settle(
        buckets.where("node <> leader").select(F.col("leader").alias("u"), F.col("node").alias("v")).distinct(),
        "near-pairs",
    )

    def both_ends(links: DataFrame) -> DataFrame:
        return links.select(F.col("u").alias("node")).unionByName(links.select(F.col("v").alias("node")))

    some = _sketches(representatives, both_ends(pairs))
    candidates = settle(_estimated(_with_both(pairs, some, ["size", "sketch"]), least), "near-candidates")
    discard(pairs, some)
    sets = _full_sets(stored, both_ends(candidates), "near-sets")
    links = settle(_verified(_with_both(candidates, sets, ["set"]), percent), "near-links")
    discard(candidates, sets)
    labels = components(links)
    more = _finish(
        buckets, labels, representatives, stored,
        least=least, rows=rows, percent=percent, block_shingles=block_shingles,
    )
    discard(buckets, representatives)
    final = labels if more.isEmpty() else components(links.unionByName(more))
    discard(links, more)
    # Of every component the first head names it.
    named = (
        classes.select("set_key", "head", F.col("head.row_key").alias("node"))
        .join(final, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    heads = named.groupBy("component").agg(F.min("head").alias("first"))
    of_class = named.join(heads, "component").select("set_key", "first")
    alone = F.struct(F.col("id").isNull().alias("no_id"), "id", "row_key")
    grouped = all_rows.join(of_class, "set_key", "left").withColumn(
        "first", F.when(F.col("n_shingles") == 0, alone).otherwise(F.col("first"))
    )
    return grouped.select(
        "row_key", "id", "n_shingles", F.col("first.id").alias("component_id"), F.col("first.row_key").alias("head")
    )


def kept_rows(docs: DataFrame, *, text: str = "text", identifier: str = "doc_id", percent: int = 80, bands: int = 40) -> DataFrame:
    """Return one row of each group, the first, with the columns of ``docs``."""
    stored = keyed(docs, "near-docs", codec=CODEC)
    view = stored.select("row_key", F.col(f"doc.`{identifier}`").alias("id"), F.col(f"doc.`{text}`").alias("text"))
    groups = near_groups(view, percent=percent, bands=bands)
    return whole_rows(stored, groups.where("row_key = head"))
