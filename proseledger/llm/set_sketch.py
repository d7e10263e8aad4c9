"""Near copies by SetSketch registers: bands of registers propose pairs, likelihood and whole sets decide.

Register i of a set holds the least of exponentially distributed numbers, one for
each element, as a truncated logarithm. The least over a union is the less of the
two, so sketches merge by the greater register. Two sets agree in a register
about as often as the Jaccard similarity says, so bands of registers serve as
buckets. Which registers are greater, less and equal, together with the sizes
of both sets, give the likelihood of every similarity; a pair that can't reach the wanted
one is dropped before whole sets are compared.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import attach
from .common import (
    ID, TEXT, as_bytes, bounded_side, map_batches, mix, narrow, salted, slices, store, text_key,
)
from .graph import components
from .ngram_join import Sets, fingerprints, shingle_sets
from .places import BLOCK_ROWS, by_place, in_places, larger_components, links_of

REGISTERS = 256
# Registers of a band; pairs at a similarity of 0.8 miss all 42 bands with a chance below 1e-6.
BAND = 6
BANDS = REGISTERS // BAND
# The base of the logarithms: one byte holds a register of any set that fits a text.
BASE = 1.2
RATE = 20.0
# A pair is dropped if the wanted similarity is e^10 times less likely than the likeliest.
SLACK = 10.0
# A set in more pairs than this is sent to several tasks.
PAIR_ROWS = 4_096
_STEPS = salted(1, 13)[0] | np.uint64(1)
_LOG = np.log(BASE)


def registers(sets: Sets) -> np.ndarray:
    """The sketch of each set, one row of bytes each.

    An element's numbers come in ascending order, each for a register drawn by
    its hash, so an element is done with once its number passes what any
    register of its set can still hold. That limit is guessed, and doubled for sets it leaves
    a register without a number below it.
    """
    sizes = np.diff(sets.bounds)
    least = np.full(len(sets) * REGISTERS, np.inf)
    limit = (np.log(REGISTERS) + 3) / (RATE * np.maximum(sizes, 1))
    todo = sizes > 0
    while todo.any():
        owner = np.repeat(np.arange(len(sets)), sizes)
        chosen = todo[owner]
        token, owner = sets.tokens[chosen], owner[chosen]
        number, step = np.zeros(len(token)), np.uint64(0)
        with np.errstate(over="ignore"):
            while len(token):
                step += _STEPS
                drawn = mix(token + step)
                number = number - np.log(((drawn >> np.uint64(11)) + 0.5) * 2.0**-53) / (REGISTERS * RATE)
                here = np.flatnonzero(number <= limit[owner])
                token, number, owner = token[here], number[here], owner[here]
                place = owner * REGISTERS + (drawn[here] % np.uint64(REGISTERS)).astype(np.int64)
                np.minimum.at(least, place, number)
        todo &= least.reshape(-1, REGISTERS).max(1) > limit
        limit = np.where(todo, 2 * limit, limit)
    with np.errstate(divide="ignore"):
        value = np.floor(1 - np.log(least) / _LOG)
    return np.clip(value, 0, 255).astype(np.uint8).reshape(-1, REGISTERS)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketches of the unions of sets."""
    return np.maximum(a, b)


def bands_of(sketches: np.ndarray) -> np.ndarray:
    """A bucket number for each band of each sketch: the band and its registers, nothing hashed."""
    parts = sketches[:, :BANDS * BAND].reshape(-1, BANDS, BAND).astype(np.int64)
    value = np.zeros(parts.shape[:2], np.int64)
    for i in range(BAND):
        value = (value << 8) | parts[:, :, i]
    return value | (np.arange(BANDS, dtype=np.int64) << (8 * BAND))


def _chance(x: np.ndarray) -> np.ndarray:
    """The chance that a set's register is greater by elements that are a share x of both sets'."""
    return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / _LOG


def log_likelihood(similarity, n, m, greater, less) -> np.ndarray:
    """Of a similarity, for sets of n and m elements with so many greater and less registers in the first."""
    u = n / (n + m)
    more, fewer = _chance(u - (1 - u) * similarity), _chance(1 - u - u * similarity)
    equal = REGISTERS - greater - less
    return greater * np.log(more) + less * np.log(fewer) + equal * np.log(np.maximum(1 - more - fewer, 1e-12))


def likeliest(n, m, greater, less, rounds: int = 30) -> np.ndarray:
    """The similarity under which the registers are likeliest, by golden sections."""
    low, high = np.zeros(len(n)), np.minimum(n, m) / np.maximum(n, m)
    ratio = (5**0.5 - 1) / 2
    for _ in range(rounds):
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        up = log_likelihood(left, n, m, greater, less) < log_likelihood(right, n, m, greater, less)
        low, high = np.where(up, left, low), np.where(up, high, right)
    return (low + high) / 2


def least_equal(percent: int) -> int:
    """Fewer equal registers than this have a chance below e^-14 at the wanted similarity."""
    wanted, sizes = percent / 100, np.linspace(percent / 100, 1, 21)
    u = sizes / (1 + sizes)
    equal = 1 - _chance(u - (1 - u) * wanted) - _chance(1 - u - u * wanted)
    chance = min(float(equal.min()), 1 - 1e-9)
    share = np.arange(1, REGISTERS) / REGISTERS
    unlikely = share * np.log(share / chance) + (1 - share) * np.log((1 - share) / (1 - chance))
    return int(np.sum((share < chance) & (REGISTERS * unlikely > 14)))


LEAST_EQUAL = {percent: least_equal(percent) for percent in range(1, 101)}


def may_reach(wanted: float, n, m, greater, less) -> np.ndarray:
    """Whether pairs may be as similar as wanted."""
    n, m = n.astype(float), m.astype(float)
    best = likeliest(n, m, greater, less)
    behind = log_likelihood(best, n, m, greater, less) - log_likelihood(wanted, n, m, greater, less)
    return (best >= wanted) | (behind <= SLACK)


def _sketches(df: DataFrame, size: int) -> DataFrame:
    """id, key, n and fp per document; the sketch too where a task first meets a set."""

    def rows(batches):
        seen: set[int] = set()
        for batch in batches:
            texts = as_bytes(batch.column(TEXT))
            for a, b in slices(texts):
                sets = shingle_sets(texts[a:b], size)
                fps, ns = fingerprints(sets), np.diff(sets.bounds)
                fresh = []
                for at, fp in enumerate(fps.tolist()):
                    if ns[at] and fp not in seen:
                        fresh.append(at)
                        seen.add(fp)
                if len(seen) >= 200_000:  # only saves work; equal sets fall together later
                    seen.clear()
                found = [None] * len(fps)
                if fresh:
                    parts = sets.split(sets.tokens)
                    some = Sets(np.concatenate([parts[at] for at in fresh]), np.append(0, np.cumsum(ns[fresh])))
                    for at, row in zip(fresh, registers(some)):
                        found[at] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(ID)[a:b], batch.column("_key")[a:b], pa.array(ns),
                     pa.array(fps, mask=ns == 0), pa.array(found, pa.binary())],
                    ["id", "key", "n", "fp", "sketch"],
                )

    return map_batches(df, rows, f"id {dict(df.dtypes)[ID]}, key long, n long, fp long, sketch binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, REGISTERS)


def _buckets(sketches: DataFrame) -> DataFrame:
    """(bucket, fp, n), a row for each band."""

    def rows(batches):
        for batch in batches:
            for a in range(0, len(batch), 4096):
                part = batch[a:a + 4096]
                if len(part):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(bands_of(_matrix(part.column("sketch"))).ravel()),
                            pa.array(np.repeat(part.column("fp").to_numpy(), BANDS)),
                            pa.array(np.repeat(part.column("n").to_numpy(), BANDS)),
                        ],
                        ["bucket", "fp", "n"],
                    )

    return map_batches(sketches.select("fp", "n", "sketch"), rows, "bucket long, fp long, n long")


def _beside(pairs: DataFrame, end: str, table: DataFrame, columns: list[str]) -> DataFrame:
    """Add columns of the set at one end of each pair. The row of a set in many pairs goes to several tasks."""
    names = [F.col(c).alias(f"{c}_{end}") for c in columns]
    counts = pairs.groupBy(F.col(end).alias("_of")).agg(F.count("*").alias("_pairs"))
    counts = store(counts.withColumn("_parts", F.ceil(F.col("_pairs") / PAIR_ROWS)), "ends")
    own = table.join(counts, F.col("fp") == F.col("_of"), "inner")
    if counts.where("_parts > 1").isEmpty():
        return pairs.join(own.select("_of", *names), F.col(end) == F.col("_of")).drop("_of")
    dealt = attach(pairs.withColumn("_of", F.col(end)), counts, ["_of"], "_pairs")
    dealt = dealt.withColumn("_part", F.pmod(F.xxhash64("a", "b"), F.col("_parts"))).drop("_of", "_parts")
    copies = own.select(
        "_of", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("_copy"), *names
    )
    on = (F.col(end) == F.col("_of")) & (F.col("_part") == F.col("_copy"))
    return dealt.join(copies, on).drop("_of", "_part", "_copy")


class _Sets(NamedTuple):
    """What deciding about pairs needs."""

    base: DataFrame
    # id, key, n, fp and sketch: one row per distinct set, with a document that has it.
    distinct: DataFrame
    size: int
    percent: int

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs that may be similar enough by their sketches."""
        both = _beside(_beside(pairs, "a", self.distinct, ["n", "sketch"]), "b", self.distinct, ["n", "sketch"])
        wanted = self.percent / 100

        def rows(batches):
            for batch in batches:
                for at in range(0, len(batch), 4096):
                    part = batch[at:at + 4096]
                    if not len(part):
                        continue
                    x, y = (_matrix(part.column(f"sketch_{end}")) for end in "ab")
                    n, m = (part.column(f"n_{end}").to_numpy() for end in "ab")
                    keep = pa.array(may_reach(wanted, n, m, (x > y).sum(1), (x < y).sum(1)))
                    yield part.select(["a", "b"]).filter(keep)

        return store(map_batches(both, rows, "a long, b long"), "likely")

    def whole(self, ends: DataFrame) -> DataFrame:
        """fp and all elements, sorted, of the sets in ``_end``, each made from one document that has it."""
        one = store(
            self.distinct.join(ends, F.col("fp") == F.col("_end"), "left_semi").select(
                F.col("id").alias("_rep_id"), F.col("key").alias("_rep_key")
            ), "representatives",
        )
        same = F.col(ID).eqNullSafe(F.col("_rep_id")) & (F.col("_key") == F.col("_rep_key"))
        texts = self.base.join(bounded_side(one, ["_rep_id"]), same).select(TEXT)
        size = self.size

        def rows(batches):
            for batch in batches:
                texts = as_bytes(batch.column(TEXT))
                for a, b in slices(texts):
                    sets = shingle_sets(texts[a:b], size)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(fingerprints(sets)), pa.array(np.diff(sets.bounds)),
                         pa.array(sets.split(sets.tokens.view(np.int64)), pa.list_(pa.int64()))],
                        ["fp", "n", "tokens"],
                    )

        made = map_batches(texts, rows, "fp long, n long, tokens array<long>")
        # An id may be repeated with the same text.
        return store(made.dropDuplicates(["fp"]), "whole_sets")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose whole sets are similar enough."""
        whole = self.whole(pairs.select(F.explode(F.array("a", "b")).alias("_end")).distinct())
        both = _beside(_beside(pairs, "a", whole, ["n", "tokens"]), "b", whole, ["n", "tokens"])
        common = F.size(F.array_intersect("tokens_a", "tokens_b"))
        both = both.select("a", "b", (F.col("n_a") + F.col("n_b")).alias("_both"), common.alias("_common"))
        enough = 100 * F.col("_common") >= self.percent * (F.col("_both") - F.col("_common"))
        return store(both.where(enough).select("a", "b"), "links")


def _with_hubs(members: DataFrame, percent: int) -> DataFrame:
    """Each member of a bucket paired with the bucket's hub.

    The hub is the set whose buckets hold most members together: of near copies,
    one that the others were made from rather than one with changes of its own.
    """
    reach = members.groupBy(F.col("fp").alias("_fp")).agg(F.sum("_rows").alias("reach"))
    ranked = store(members.join(reach, F.col("fp") == F.col("_fp")).drop("_fp", "_rows"), "ranked")
    hubs = ranked.groupBy("bucket").agg(
        F.max(F.struct("reach", "fp", "n")).alias("hub"), F.count("*").alias("_weight")
    ).select("bucket", "_weight", F.col("hub.fp").alias("hub"), F.col("hub.n").alias("m"))
    pairs = attach(ranked, hubs, ["bucket"], "_weight").where("fp <> hub")
    pairs = pairs.where(f"100 * least(n, m) >= {percent} * greatest(n, m)")
    return pairs.select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b")).distinct()


def _candidates(percent: int, band, side, n, comp, sketch):
    """Pairs (one row, several others) of different components that may be similar enough.

    Each component is held against all larger ones, so a bucket that is nearly one
    costs little. A pair is left to the first band in which it agrees.
    """
    wanted = percent / 100
    bands = bands_of(sketch)
    for at, other in larger_components(side, n, comp, percent):
        other = other[(bands[other, :band] != bands[at, :band]).all(1)]
        x, y = sketch[at], sketch[other]
        other = other[(x == y).sum(1) >= LEAST_EQUAL[percent]]
        if len(other):
            x, y = sketch[at], sketch[other]
            keep = may_reach(wanted, np.full(len(other), n[at]), n[other], (x > y).sum(1), (x < y).sum(1))
            other = other[keep]
        if len(other):
            yield at, other


def _pairs_of(table: pa.Table, percent: int):
    column = lambda name: table.column(name).to_numpy()
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, REGISTERS)
    return _candidates(
        percent, int(column("bucket")[0] >> (8 * BAND)), column("side"), column("n"), column("comp"), sketch
    )


def _with_candidates(percent: int):
    """Of each place, the rows that may be similar enough to one of another component."""

    def of_place(table: pa.Table):
        chosen = np.zeros(table.num_rows, bool)
        for at, other in _pairs_of(table, percent):
            chosen[at] = True
            chosen[other] = True
        if chosen.any():
            kept = table.select(["place", "bucket", "side", "fp", "comp"]).filter(pa.array(chosen))
            yield from kept.to_batches()

    return by_place(of_place)


def _confirmed_links(percent: int):
    """Of each place, links by whole sets that join its components: one less than these at most."""

    def of_place(table: pa.Table):
        yield from links_of(table, _pairs_of(table, percent), percent)

    return by_place(of_place)


def _crossing(members: DataFrame, links: DataFrame, decide: _Sets) -> DataFrame:
    """Links between sets that share a bucket and that the links so far don't connect.

    Two passes over the buckets with several components: sketches find the sets that may have such a link,
    and these are compared as a whole.
    """
    known = store(components(links), "components").select(
        F.col("node").alias("_node"), F.col("component").alias("_component")
    )
    members = store(
        members.join(known, F.col("fp") == F.col("_node"), "left").select(
            "bucket", "fp", "n", F.coalesce("_component", "fp").alias("comp")
        ), "members",
    )
    placed = in_places(members, "bucket", BLOCK_ROWS)
    sketches = decide.distinct.select(F.col("fp").alias("_fp"), "n", "sketch")
    percent = decide.percent

    def placed_with(rows: DataFrame, table: DataFrame) -> DataFrame:
        joined = rows.join(table, F.col("fp") == F.col("_fp")).drop("_fp")
        return joined.repartition("place").sortWithinPartitions("place")

    near = store(
        map_batches(
            placed_with(placed, sketches), _with_candidates(percent),
            "place long, bucket long, side int, fp long, comp long",
        ), "crossing",
    )
    whole = decide.whole(near.select(F.col("fp").alias("_end")).distinct())
    both = sketches.join(whole.select(F.col("fp").alias("_of"), "tokens"), F.col("_fp") == F.col("_of")).drop("_of")
    found = map_batches(placed_with(near, both), _confirmed_links(percent), "a long, b long")
    return store(found.distinct(), "crossing_links")


def near_duplicates(
    df: DataFrame,
    size: int = 2,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``_id, n_shingles, component_id``, plus ``_key`` (hash of the text).

    Two documents link when the Jaccard similarity of their sets of word shingles is
    at least ``percent`` / 100, which is confirmed on whole sets; ``component_id`` is the smallest
    id that links lead to, the document's own included.

    Equal sets are one from the start. Sets that agree in a band of registers share a
    bucket. First every member is compared with its bucket's hub, then in every bucket
    what these links don't connect; whole sets are compared only where
    the likelihood of all registers allows. Rows are written per member and per link that joins
    two components, never per pair, so a group of n near copies costs n; no bucket is capped, and large
    ones are compared in pairs of blocks. A link at similarity 0.8 is missed by all bands, or
    by the likelihood, with a chance near 1e-6 or 1e-5, a closer one with less.

    Sets and shingles are known by 64-bit hashes. A NULL or empty text, or one of white space
    only, has ``n_shingles`` 0 and is linked with nothing. A very long text is one
    row whose sketch is no longer than others. Ids may be NULL or repeated; a NULL id is never the
    smallest unless all are NULL. An empty table gives an empty result. Other columns are ignored.
    """
    base = narrow(df, id_col, text_col).select(ID, TEXT, text_key(F.col(TEXT)).alias("_key"))
    made = store(_sketches(base, size), "sketches")
    sets = made.select("id", "key", "n", "fp")
    distinct = store(made.where(F.col("sketch").isNotNull()).dropDuplicates(["fp"]), "distinct")
    buckets = store(_buckets(distinct), "buckets")
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("_rows")).where("_rows > 1")
    members = store(
        attach(buckets, shared.withColumn("_weight", F.col("_rows")), ["bucket"], "_weight"), "members"
    )
    decide = _Sets(base, distinct, size, percent)
    tested = store(_with_hubs(members, percent), "hubs")
    links = decide.confirmed(decide.likely(tested))
    links = links.unionByName(_crossing(members, links, decide))

    known = components(links).select(F.col("node").alias("_node"), "component")
    least = made.where("n > 0").groupBy("fp").agg(F.min("id").alias("least"))
    by_set = store(
        least.join(known, F.col("fp") == F.col("_node"), "left").select(
            "fp", "least", F.coalesce("component", "fp").alias("component")
        ), "components",
    )
    # A component may hold a third of all sets.
    ids = by_set.groupBy("component").agg(F.min("least").alias("_component_id"), F.count("*").alias("_rows"))
    by_set = attach(by_set, ids, ["component"], "_rows").select(F.col("fp").alias("_set"), "_component_id")
    by_set = store(by_set, "by_set")
    return _labelled(sets, by_set)


def _labelled(sets: DataFrame, by_set: DataFrame) -> DataFrame:
    """Every document with its set's component. A set of very many documents is not joined in one task."""
    weights = sets.where("n > 0").groupBy(F.col("fp").alias("_set")).agg(F.count("*").alias("_rows"))
    table = by_set.join(weights, "_set")
    some = attach(sets.where("n > 0").withColumn("_set", F.col("fp")), table, ["_set"], "_rows")
    none = sets.where("n = 0").withColumn("_component_id", F.col("id"))
    return some.drop("_set").unionByName(none).select(
        F.col("id").alias("_id"), F.col("key").alias("_key"), F.col("n").alias("n_shingles"),
        F.col("_component_id").alias("component_id"),
    )
