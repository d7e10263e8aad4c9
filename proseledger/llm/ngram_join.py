"""Near copies by word shingles: Jaccard join with prefix filters under several token orders."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import attach
from .common import (
    ID, TEXT, as_bytes, map_batches, mix, narrow, salted, shuffles_dropped, slices, small_side, store, stored,
    text_key, word_bounds, word_hashes,
)
from .graph import components
from .places import BLOCK_ROWS, by_place, in_places, larger_components, links_of

# Tokens are counted in this many cells; common cells come last in every order.
CELLS = 1 << 17
# Prefix orders: the first finds candidates, the others must agree.
ORDERS = 3
# Sets of one class differ in size by less than a seventh.
CLASSES_OF_SIZE = 7.0
# In buckets up to this size all neighbours are compared from the start.
SMALL_BUCKET = 8
# Bytes of the shortest signature.
LEAST_BYTES = 16
PREFIXES = [f"prefix{order}" for order in range(1, ORDERS)]
_COEFFICIENTS = salted(64, 2)
_ORDER_SALTS = salted(ORDERS, 3)


class Sets(NamedTuple):
    """The sets of several texts: their tokens one after the other, each set sorted."""

    tokens: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def split(self, values: np.ndarray) -> list[np.ndarray]:
        """A value per token, as one array per set."""
        edges = self.bounds.tolist()
        return [values[a:b] for a, b in zip(edges[:-1], edges[1:])]


def shingle_sets(texts: list[bytes], size: int) -> Sets:
    """The set of hashed shingles of each text.

    Words are runs of bytes other than space and 0x09-0x0D, A-Z as a-z. A text
    with fewer words than ``size`` has its whole sequence as one shingle.
    """
    buffer = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    starts, ends = word_bounds(buffer)
    hashes = word_hashes(buffer, starts, ends)
    cuts = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
    parts, begin = [], 0
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
        for j in range(size):
            rolled += hashes[j:j + len(rolled)] * _COEFFICIENTS[j]
        rolled = mix(rolled)
        for end in cuts.tolist():
            count = end - begin
            if count >= size:
                part = np.sort(rolled[begin:end - size + 1])
                if count > size and (same := part[1:] == part[:-1]).any():
                    part = part[np.concatenate([[True], ~same])]
            else:
                part = np.empty(min(count, 1), np.uint64)
                if count:
                    part[0] = (hashes[begin:end] * _COEFFICIENTS[:count]).sum(dtype=np.uint64)
                    part = mix(part + np.uint64(count))
            parts.append(part)
            begin = end
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return Sets(np.concatenate(parts), bounds)


def fingerprints(sets: Sets) -> np.ndarray:
    """A 64-bit number for each set."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(sets.tokens) + 1, np.uint64)
        np.cumsum(mix(sets.tokens ^ _COEFFICIENTS[63]), out=sums[1:])
        total = sums[sets.bounds[1:]] - sums[sets.bounds[:-1]]
        return mix(total ^ np.diff(sets.bounds).astype(np.uint64)).view(np.int64)


def prefix_length(n: int, percent: int) -> int:
    """Of two sets that are similar enough, these many first tokens must share one."""
    return n - -(-n * percent // 100) + 1


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - 17)).astype(np.int64)


def order_keys(tokens: np.ndarray, levels: np.ndarray, order: int) -> np.ndarray:
    """Sort keys of tokens under one of the global orders: rare cells first, then by hash."""
    level = levels[_cells(tokens)].astype(np.uint64) << np.uint64(60)
    return level | (mix(tokens ^ _ORDER_SALTS[order]) >> np.uint64(4))


def prefixes(sets: Sets, levels: np.ndarray, order: int, percent: int) -> list[np.ndarray]:
    """The tokens of each set that come first under an order."""
    out = []
    for tokens, keys in zip(sets.split(sets.tokens), sets.split(order_keys(sets.tokens, levels, order))):
        count = prefix_length(len(tokens), percent)
        out.append(tokens[np.argpartition(keys, count - 1)[:count]] if count < len(tokens) else tokens)
    return out


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes]]]:
    texts = as_bytes(batch.column(TEXT))
    for begin, end in slices(texts):
        yield begin, end, texts[begin:end]


def _sets(df: DataFrame, size: int) -> DataFrame:
    """One row per document (id, key, n, fp), and one per task and cell with its count of tokens."""

    def rows(batches):
        counts = np.zeros(CELLS, np.int64)
        for batch in batches:
            ids, keys, ns, fps = batch.column(ID), batch.column("_key"), [], []
            for _, _, texts in _texts(batch):
                sets = shingle_sets(texts, size)
                counts += np.bincount(_cells(sets.tokens), minlength=CELLS)
                ns.append(np.diff(sets.bounds))
                fps.append(fingerprints(sets))
            if not ns:
                continue
            n, fp = np.concatenate(ns), np.concatenate(fps)
            nothing = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, keys, pa.array(n), pa.array(fp, mask=n == 0), nothing, nothing],
                ["id", "key", "n", "fp", "cell", "count"],
            )
        cells = np.flatnonzero(counts)
        nothing = pa.nulls(len(cells), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [nothing, nothing, nothing, nothing, pa.array(cells), pa.array(counts[cells])],
            ["id", "key", "n", "fp", "cell", "count"],
        )

    return map_batches(
        df, rows, "id long, key long, n long, fp long, cell long, count long"
    )


def _levels(cells: DataFrame) -> np.ndarray:
    """How far the count of each cell stands out: 0 for the many, up to 15. A table of fixed size."""
    counts = np.zeros(CELLS)
    for cell, count in cells.groupBy("cell").agg(F.sum("count")).collect():
        counts[cell] = count
    mean = counts.mean()
    noise = 6 * math.sqrt(mean) + 16
    excess = np.maximum(counts - mean, 0) / noise
    return np.clip(np.floor(np.log2(np.maximum(excess, 0.5))) + 1, 0, 15).astype(np.uint8)


def _postings(df: DataFrame, levels, size: int, percent: int) -> DataFrame:
    """(token, fp, n) for the prefix of every set; a set seen before in a task is left out."""

    def rows(batches):
        seen: set[int] = set()
        table = levels.value
        for batch in batches:
            for _, _, texts in _texts(batch):
                sets = shingle_sets(texts, size)
                fps, ns = fingerprints(sets), np.diff(sets.bounds)
                fresh = []
                for at, fp in enumerate(fps.tolist()):
                    if fp not in seen and ns[at]:
                        fresh.append(at)
                        seen.add(fp)
                if len(seen) >= 200_000:  # only saves work; equal rows are dropped later too
                    seen.clear()
                if not fresh:
                    continue
                every = prefixes(sets, table, 0, percent)
                tokens = [every[at] for at in fresh]
                each = [len(t) for t in tokens]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens).view(np.int64)),
                        pa.array(np.repeat(fps[fresh], each)),
                        pa.array(np.repeat(ns[fresh].astype(np.int32), each)),
                    ],
                    ["token", "fp", "n"],
                )

    return map_batches(df, rows, "token long, fp long, n int")


def _chains(percent: int):
    """Per token, over rows sorted by token, n and fp: candidate pairs and members.

    Kind 2: two sets that are the whole bucket. Kind 0: neighbours in other
    small buckets. Kind 1: the members of buckets of three or more.
    """

    def out(kind, a, b, n, m):
        return pa.RecordBatch.from_arrays(
            [pa.array(kind.astype(np.int8)), pa.array(a), pa.array(b), pa.array(n), pa.array(m)],
            ["kind", "a", "b", "n", "m"],
        )

    def rows(batches):
        rest, big = None, False  # the last bucket so far; whether it goes on from an earlier part

        def emit(token, fp, n, first_is_big):
            if len(token) == 0:
                return
            new_token = np.diff(token, prepend=token[0] - 1) != 0
            starts = np.flatnonzero(new_token)
            sizes = np.diff(np.append(starts, len(token)))
            size = np.repeat(sizes, sizes)
            if first_is_big:
                size[:sizes[0]] = len(token) + SMALL_BUCKET
            right = np.flatnonzero((size <= SMALL_BUCKET) & ~new_token)
            left = right - 1
            lo, hi = np.minimum(n[left], n[right]), np.maximum(n[left], n[right])
            near = lo.astype(np.int64) * 100 >= hi.astype(np.int64) * percent
            left, right, lo, hi = left[near], right[near], lo[near], hi[near]
            yield out(np.where(size[left] == 2, 2, 0), fp[left], fp[right], lo, hi)
            keep = size >= 3
            yield out(np.ones(keep.sum()), token[keep], fp[keep], n[keep], n[keep])

        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if rest is not None:
                columns = [np.concatenate([x, y]) for x, y in zip(rest, columns)]
            token, fp, _ = columns
            if len(token) == 0:
                continue
            fresh = np.ones(len(token), bool)
            fresh[1:] = (token[1:] != token[:-1]) | (fp[1:] != fp[:-1])
            columns = [c[fresh] for c in columns]
            token = columns[0]
            last = int(np.searchsorted(token, token[-1]))
            if last == 0 and len(token) > 1_000_000:  # write a part of it, go on from its last row
                yield from emit(*[c[:-1] for c in columns], True)
                rest, big = [c[-1:] for c in columns], True
                continue
            yield from emit(*[c[:last] for c in columns], big)
            big = big and last == 0
            rest = [c[last:] for c in columns]
        if rest is not None:
            yield from emit(*rest, big)

    return rows


def _further_prefixes(df: DataFrame, wanted: DataFrame, levels, size: int, percent: int) -> DataFrame:
    """fp, n and the prefixes of wanted sets under the orders after the first.

    Tokens are cut to 32 bits; ``lost`` counts those that fell together.
    """

    def rows(batches):
        seen: set[int] = set()
        table, kind = levels.value, pa.list_(pa.int32())
        for batch in batches:
            for _, _, texts in _texts(batch):
                sets = shingle_sets(texts, size)
                fps, ns = fingerprints(sets), np.diff(sets.bounds)
                fresh = []
                for at, fp in enumerate(fps.tolist()):
                    if ns[at] and fp not in seen:
                        fresh.append(at)
                        seen.add(fp)
                if len(seen) >= 200_000:
                    seen.clear()
                short = [prefixes(sets, table, order, percent) for order in range(1, ORDERS)]
                short = [[np.unique(p[at].astype(np.uint32).view(np.int32)) for at in fresh] for p in short]
                whole = np.array([prefix_length(int(ns[at]), percent) for at in fresh], np.int64)
                least = np.array([min(len(p[i]) for p in short) for i in range(len(fresh))], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fps[fresh]), pa.array(ns[fresh]), pa.array(whole - least),
                     *[pa.array(p, kind) for p in short]],
                    ["fp", "n", "lost", *PREFIXES],
                )

    made = map_batches(
        df, rows, "fp long, n long, lost long" + "".join(f", {p} array<int>" for p in PREFIXES)
    )
    return made.join(wanted, "fp", "left_semi").dropDuplicates(["fp"])


def _whole_sets(df: DataFrame, wanted: DataFrame, sets: DataFrame, size: int) -> DataFrame:
    """fp, n and all tokens of the wanted sets, each made from one document that has it."""
    one = (
        sets.join(small_side(store(wanted, "ends")), "fp", "left_semi")
        .groupBy("fp")
        .agg(F.min(F.struct("id", "key")).alias("row"))
        .select(F.col("row.id").alias("_rep_id"), F.col("row.key").alias("_rep_key"))
    )
    one = store(one, "representatives")
    # 16 bytes a row; where they are too many the texts are shuffled instead.
    texts = df.join(
        small_side(one), F.col(ID).eqNullSafe(F.col("_rep_id")) & (F.col("_key") == F.col("_rep_key"))
    ).select(TEXT)

    def rows(batches):
        for batch in batches:
            for _, _, texts in _texts(batch):
                sets = shingle_sets(texts, size)
                tokens = sets.split(sets.tokens.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fingerprints(sets)), pa.array(np.diff(sets.bounds)),
                     pa.array(tokens, pa.list_(pa.int64()))],
                    ["fp", "n", "tokens"],
                )

    made = map_batches(texts, rows, "fp long, n long, tokens array<long>")
    # An id may be repeated with the same text.
    return made.dropDuplicates(["fp"])


def _least_shared(n, m, percent: int):
    """Prefix tokens that two similar enough sets of these sizes share at least, under any order.

    Of the common tokens, those behind the prefix of the set whose prefix ends
    first are no more than it has there; all others are in both prefixes.
    """
    common = F.ceil(percent * (n + m) / (100 + percent))
    behind = F.ceil(percent * F.greatest(n, m) / 100) - 1
    return F.greatest(F.lit(1), common - behind)


class _Join(NamedTuple):
    """What both rounds of verification need."""

    base: DataFrame
    sets: DataFrame
    bits: DataFrame
    levels: object
    size: int
    percent: int

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose signatures allow enough shared tokens; a signature is far shorter than a prefix."""
        both = _both_sides(pairs, self.bits, ["n", "bits", "lost"])
        return store(map_batches(both, _likely_pairs(self.percent), "a long, b long"), "likely")

    def prefixes_of(self, pairs: DataFrame) -> DataFrame:
        ends = small_side(store(_ends(pairs), "ends"))
        return _further_prefixes(self.base, ends, self.levels, self.size, self.percent)

    def sets_of(self, pairs: DataFrame) -> DataFrame:
        return _whole_sets(self.base, _ends(pairs), self.sets, self.size)

    def agreeing(self, pairs: DataFrame) -> DataFrame:
        """Pairs that share prefix tokens under every order."""
        with stored(self.prefixes_of(pairs), "prefixes") as short:
            both = _both_sides(pairs, short, ["n", "lost", *PREFIXES])
            least = _least_shared(F.col("n_a"), F.col("n_b"), self.percent)
            least = F.greatest(F.lit(1), least - F.col("lost_a") - F.col("lost_b"))
            for prefix in PREFIXES:
                both = both.where(F.size(F.array_intersect(f"{prefix}_a", f"{prefix}_b")) >= least)
            return store(both.select("a", "b"), "filtered")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs that are similar enough by their whole sets."""
        with stored(self.sets_of(pairs), "whole_sets") as whole:
            both = _both_sides(pairs, whole, ["n", "tokens"])
            common = F.size(F.array_intersect("tokens_a", "tokens_b"))
            union = F.col("n_a") + F.col("n_b") - F.col("_common")
            return store(
                both.withColumn("_common", common)
                .where(100 * F.col("_common") >= self.percent * union)
                .select("a", "b"),
                "links",
            )


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()


def _both_sides(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    for end in ("a", "b"):
        side = table.select(
            F.col("fp").alias(f"_fp_{end}"), *[F.col(c).alias(f"{c}_{end}") for c in columns]
        )
        pairs = pairs.join(side, F.col(end) == F.col(f"_fp_{end}"))
    return pairs


def similar_sets(
    df: DataFrame,
    size: int = 5,
    percent: int = 75,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The documents' sets, and links that connect all sets that are similar through others.

    See ``near_duplicates``. Returns the tables ``id, key, n, fp`` and ``a, b`` (of fp).
    """
    spark = df.sparkSession
    base = narrow(df, id_col, text_col).select(ID, TEXT, text_key(F.col(TEXT)).alias("_key"))
    made = store(_sets(base, size), "shingles")
    sets = made.where(F.col("cell").isNull()).select("id", "key", "n", "fp")
    levels = spark.sparkContext.broadcast(_levels(made.where(F.col("cell").isNotNull())))

    # First a few pairs of every bucket: a group of near copies falls together by
    # these, at a cost linear in the postings.
    buckets = (
        _postings(base, levels, size, percent)
        .repartition("token")
        .sortWithinPartitions("token", "n", "fp")
    )
    found = store(
        map_batches(buckets, _chains(percent), "kind byte, a long, b long, n int, m int"), "buckets"
    )
    ordered = lambda p, *more: p.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "n", "m", *more
    )
    least = _least_shared(F.max("n").cast("long"), F.max("m").cast("long"), percent)
    # A pair that is alone in all its buckets has been counted; others may share more.
    members = found.where("kind = 1").select(
        F.col("a").alias("token"), F.col("b").alias("fp"), "n"
    )
    with_hubs, tops, in_buckets = _with_hubs(members, percent)
    neighbours = store(
        ordered(found.where("kind <> 1"), "kind").unionByName(
            ordered(with_hubs.withColumn("kind", F.lit(0).cast("byte")), "kind")
        ).groupBy("a", "b")
        .agg(F.min("kind").alias("kind"), F.count("*").alias("shared"), least.alias("least"))
        .where("kind = 0 or shared >= least").select("a", "b"), "neighbours",
    )
    wanted = store(_ends(neighbours).unionByName(in_buckets).distinct(), "ends")
    bits = _signatures(base, small_side(wanted), size)
    join = _Join(base, sets, bits, levels, size, percent)
    links = join.verified(join.agreeing(join.likely(neighbours)))

    # Then what the links so far don't connect, in the tasks.
    return sets, links.unionByName(_links_across(members, tops, links, join))


def _with_hubs(members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs of each member with the hub of its size in every bucket, and of these with the bucket's;
    the hub ``top`` and the rows of every bucket; and ``fp`` of every member, once.

    The hub is the set whose buckets hold most members together. Of near copies
    it is one without changes of its own, which is nearest to the others.
    """
    sizes = members.groupBy("token").agg(F.count("*").alias("_size")).withColumnRenamed("token", "_token")
    reach = (
        members.join(sizes, F.col("token") == F.col("_token"))
        .groupBy(F.col("fp").alias("_fp")).agg(F.sum("_size").alias("reach"))
    )
    reach = store(reach, "reach")
    ranked = store(
        members.withColumn("cls", F.floor(F.log("n") * CLASSES_OF_SIZE).cast("int"))
        .join(reach, F.col("fp") == F.col("_fp")).drop("_fp"), "ranked",
    )
    best = F.max_by(F.struct("fp", "n"), F.struct("reach", "fp"))
    hubs = store(
        ranked.groupBy(F.col("token").alias("_token"), F.col("cls").alias("_cls"))
        .agg(best.alias("hub"), F.max("reach").alias("reach"), F.count("*").alias("_rows")), "hubs",
    )
    tops = hubs.groupBy(F.col("_token").alias("_of")).agg(
        F.max_by("hub", F.struct("reach", "hub")).alias("top"), F.sum("_rows").alias("_rows")
    )
    to_hub = ranked.join(
        hubs.drop("reach", "_rows"), (F.col("token") == F.col("_token")) & (F.col("cls") == F.col("_cls"))
    ).select(F.col("fp").alias("a"), F.col("hub.fp").alias("b"), F.col("n"), F.col("hub.n").alias("m"))
    to_top = hubs.join(tops, F.col("_token") == F.col("_of")).select(
        F.col("hub.fp").alias("a"), F.col("top.fp").alias("b"), F.col("hub.n").alias("n"), F.col("top.n").alias("m")
    )
    pairs = to_hub.unionByName(to_top).where("a <> b").select(
        "a", "b", F.least("n", "m").alias("n"), F.greatest("n", "m").alias("m")
    )
    pairs = pairs.where(f"100 * n >= {percent} * m").distinct()
    tops = tops.select(F.col("_of").alias("token"), F.col("top.fp").alias("top"), "_rows")
    return pairs, tops, reach.select(F.col("_fp").alias("fp"))


def signature(tokens: np.ndarray, size: int) -> bytes:
    """Bits of some tokens: one for each, by its hash."""
    bits = np.zeros(size * 8, bool)
    bits[(tokens >> np.uint64(7)) % np.uint64(size * 8)] = True
    return np.packbits(bits).tobytes()


def signature_bytes(tokens: int) -> int:
    """Two to four bits a token, in a power of two of bytes."""
    return max(LEAST_BYTES, 1 << max(0, (tokens - 1).bit_length() - 2))


def _signed(sets: list[np.ndarray]) -> tuple[list[bytes], np.ndarray]:
    """The signature of each set of tokens, and how many tokens fell on a bit that was set."""
    bits = [signature(tokens, signature_bytes(len(tokens))) for tokens in sets]
    set_ = [int(np.bitwise_count(np.frombuffer(b, np.uint8)).sum(dtype=np.int64)) for b in bits]
    return bits, np.array([len(tokens) for tokens in sets], np.int64) - np.array(set_, np.int64)


def _signatures(df: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """fp, n and the signature of the whole set, with how many tokens fell on a bit that was set."""

    def rows(batches):
        seen: set[int] = set()
        for batch in batches:
            for _, _, texts in _texts(batch):
                sets = shingle_sets(texts, size)
                fps, ns = fingerprints(sets), np.diff(sets.bounds)
                fresh = []
                for at, fp in enumerate(fps.tolist()):
                    if ns[at] and fp not in seen:
                        fresh.append(at)
                        seen.add(fp)
                if len(seen) >= 200_000:
                    seen.clear()
                every = sets.split(sets.tokens)
                bits, lost = _signed([every[at] for at in fresh])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fps[fresh]), pa.array(ns[fresh]), pa.array(bits, pa.binary()), pa.array(lost)],
                    ["fp", "n", "bits", "lost"],
                )

    made = map_batches(df, rows, "fp long, n long, bits binary, lost long")
    return store(made.join(wanted, "fp", "left_semi").dropDuplicates(["fp"]), "signatures")


class _Bits:
    """The signatures of one kind of all rows of a place.

    Two sets share no more tokens than their signatures have common bits and the one with
    fewer lost tokens has lost. Widths differ by a factor of two at most where sizes
    allow a link; the wider signature is folded then, and the other one's loss counts.
    """

    def __init__(self, raw: list[bytes], lost: np.ndarray) -> None:
        self.width, self.lost = np.array([len(b) for b in raw]), lost
        self.place, self.whole, self.half = np.empty(len(raw), np.int64), {}, {}
        for w in np.unique(self.width).tolist():
            rows = np.flatnonzero(self.width == w)
            self.place[rows] = np.arange(len(rows))
            self.whole[w] = np.frombuffer(b"".join(raw[i] for i in rows), "<u8").reshape(len(rows), -1)
            if w > LEAST_BYTES:
                self.half[w] = self.whole[w][:, :w // 16] | self.whole[w][:, w // 16:]

    def _known(self, w: int):
        """Widths that can be held against a width, and where each side's words are."""
        return (w, self.whole, self.whole), (2 * w, self.half, self.whole), (w // 2, self.whole, self.half)

    def most_shared(self, at: int, rows: np.ndarray) -> np.ndarray:
        """No more tokens than this does a row share with each of others."""
        # Where widths differ more, nothing is known.
        w, out = int(self.width[at]), np.full(len(rows), np.iinfo(np.int64).max)
        for v, theirs, mine in self._known(w):
            here = np.flatnonzero(self.width[rows] == v)
            if not len(here):
                continue
            some = rows[here]
            common = np.bitwise_count(theirs[v][self.place[some]] & mine[w][self.place[at]]).sum(1, dtype=np.int64)
            own, other = self.lost[at], self.lost[some]
            out[here] = common + (np.minimum(own, other) if v == w else own if v > w else other)
        return out

    def most_shared_by_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The same for each pair of rows."""
        out = np.full(len(left), np.iinfo(np.int64).max)
        for w in self.whole:
            for v, theirs, mine in self._known(w):
                here = np.flatnonzero((self.width[left] == w) & (self.width[right] == v))
                if not len(here):
                    continue
                a, b = left[here], right[here]
                common = np.bitwise_count(theirs[v][self.place[b]] & mine[w][self.place[a]]).sum(1, dtype=np.int64)
                own, other = self.lost[a], self.lost[b]
                out[here] = common + (np.minimum(own, other) if v == w else own if v > w else other)
        return out


def _least_common(n, m, percent: int):
    """Tokens that two similar enough sets of these sizes share at least."""
    return -(-percent * (n + m) // (100 + percent))


def _likely_pairs(percent: int):
    """Pairs whose whole sets may share enough tokens, by their signatures."""

    def rows(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            column = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            n, lost = (np.concatenate([column(f"{c}_a"), column(f"{c}_b")]) for c in ("n", "lost"))
            bits = _Bits(batch.column("bits_a").to_pylist() + batch.column("bits_b").to_pylist(), lost)
            left = np.arange(batch.num_rows)
            right = left + batch.num_rows
            enough = bits.most_shared_by_pairs(left, right) >= np.maximum(_least_common(n[left], n[right], percent), 1)
            yield batch.select(["a", "b"]).filter(pa.array(enough))

    return rows


def _agreeing(table: pa.Table, percent: int, prefix_bits: list[_Bits] = ()):
    """Pairs (a row of a place, several others) of different components that may share enough tokens.

    Enough of the whole set, then enough of the prefix under each order that is given, by their signatures.
    """
    column = lambda name: table.column(name).to_numpy()
    n = column("n")
    whole = _Bits(table.column("bits").to_pylist(), column("lost"))
    for at, rows in larger_components(column("side"), n, column("comp"), percent):
        rows = rows[whole.most_shared(at, rows) >= np.maximum(_least_common(n[rows], n[at], percent), 1)]
        for bits in prefix_bits:
            if not len(rows):
                break
            behind = -(-percent * np.maximum(n[rows], n[at]) // 100) - 1
            common = _least_common(n[rows], n[at], percent) - behind
            rows = rows[bits.most_shared(at, rows) >= np.maximum(common, 1)]
        if len(rows):
            yield at, rows


def _with_candidates(percent: int):
    """Of each place, the rows that may be similar enough to one of another component."""

    def of_place(table: pa.Table):
        chosen = np.zeros(table.num_rows, bool)
        for at, other in _agreeing(table, percent):
            chosen[at] = True
            chosen[other] = True
        if chosen.any():
            kept = table.select(["place", "side", "fp", "comp"]).filter(pa.array(chosen))
            yield from kept.to_batches()

    return by_place(of_place)


def _confirmed_links(levels, percent: int):
    """Of each place, links by whole sets that join its components."""

    def of_place(table: pa.Table):
        tokens = [t.values.to_numpy().view(np.uint64) for t in table.column("tokens")]
        sets = Sets(np.concatenate(tokens), np.append(0, np.cumsum([len(t) for t in tokens])))
        prefix_bits = [_Bits(*_signed(prefixes(sets, levels.value, order, percent))) for order in range(ORDERS)]
        yield from links_of(table, _agreeing(table, percent, prefix_bits), percent)

    return by_place(of_place)


def _links_across(members: DataFrame, tops: DataFrame, links: DataFrame, join: _Join) -> DataFrame:
    """Links between sets that share a bucket and that the links so far don't connect.

    Buckets with the same hub are one: sets that share a bucket share its hub, and a near copy's many
    buckets have few. Signatures of whole sets find those that may have a link. Where signatures of
    their prefixes in all orders allow it too, these are compared as a whole.
    """
    known = store(components(links), "components").select(
        F.col("node").alias("_node"), F.col("component").alias("_component")
    )
    met = attach(members, tops, ["token"], "_rows").select("top", "fp", F.col("n").cast("long").alias("n")).distinct()
    met = met.join(known, F.col("fp") == F.col("_node"), "left")
    met = store(met.select("top", "fp", "n", F.coalesce("_component", "fp").alias("comp")), "members")
    placed = store(in_places(met, "top", BLOCK_ROWS).drop("top"), "placed")

    def placed_with(rows: DataFrame, table: DataFrame) -> DataFrame:
        joined = rows.join(table.withColumnRenamed("fp", "_fp"), F.col("fp") == F.col("_fp")).drop("_fp")
        return joined.repartition("place").sortWithinPartitions("place")

    near = store(
        map_batches(
            placed_with(placed, join.bits), _with_candidates(join.percent), "place long, side int, fp long, comp long"
        ), "crossing",
    )
    with stored(_whole_sets(join.base, near.select("fp").distinct(), join.sets, join.size), "whole_sets") as whole:
        near_bits = join.bits.join(small_side(whole.select("fp")), "fp", "left_semi")
        tokens = whole.select(F.col("fp").alias("_of"), "tokens")
        both = near_bits.join(tokens, F.col("fp") == F.col("_of")).drop("_of")
        found = map_batches(placed_with(near, both), _confirmed_links(join.levels, join.percent), "a long, b long")
        return store(found.distinct(), "crossing_links")


def near_duplicates(
    df: DataFrame,
    size: int = 5,
    percent: int = 75,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``_id, n_shingles, component_id``, plus ``_key`` (hash of the text).

    Two documents link when the Jaccard similarity of their sets of word
    shingles is at least ``percent`` / 100; ``component_id`` is the smallest id
    that links lead to, the document's own included.

    Equal sets are one set from the start. Two sets that are similar share a
    token among the first ``n - ceil(percent * n) + 1`` of either under any
    order of all tokens, so candidates come from buckets of prefix tokens under
    one order. Their signatures must allow enough common tokens, and they must also share prefix tokens (as many as
    follow from their sizes) under two more before their whole sets are compared. All orders put tokens of crowded cells last, which
    keeps passages that many documents share out of the prefixes. Candidates
    are first each set with the hub of its size in every bucket, then, within the tasks, all pairs
    that the links found so far don't connect. Rows are written per set and bucket and per link that joins two
    components, never per pair; large buckets with several groups are compared in pairs of blocks.
    No bucket is capped. The links found connect what similar sets connect; they are not all pairs of similar sets.

    Sets and tokens are known by 64-bit hashes. A NULL or empty text, or one of
    white space only, has ``n_shingles`` 0 and is linked with nothing. Ids may
    be NULL or repeated; a NULL id is never the smallest unless all are NULL.
    An empty table gives an empty result. Other columns are ignored.
    """
    with shuffles_dropped(df.sparkSession):
        sets, links = similar_sets(df, size, percent, id_col, text_col)
        known = components(links).select(F.col("node").alias("_node"), "component")
        distinct = sets.where("n > 0").groupBy("fp").agg(F.min("id").alias("least"))
        with_component = distinct.join(known, F.col("fp") == F.col("_node"), "left").select(
            "fp", "least", F.coalesce("component", "fp").alias("component")
        )
        with_component = store(with_component, "components")
        least = store(
            with_component.groupBy("component").agg(F.min("least").alias("component_id")), "least"
        )
        by_set = store(
            with_component.join(least, "component").select(
                F.col("fp").alias("_of"), F.col("component_id").alias("_component_id")
            ), "by_set",
        )
    return sets.join(by_set, F.col("fp") == F.col("_of"), "left").select(
        F.col("id").alias("_id"), F.col("key").alias("_key"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("_component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def drop_near_duplicates(
    df: DataFrame,
    size: int = 5,
    percent: int = 75,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Of every group of linked documents, the row with the smallest id; all columns.

    Texts without words are in no group and stay. Of rows that share id and text
    one stays; among different texts with the smallest id the hash decides.
    """
    with shuffles_dropped(df.sparkSession):
        found = store(near_duplicates(df, size, percent, id_col, text_col), "found").where("n_shingles > 0")
        least = (
            found.where(F.col("_id").eqNullSafe(F.col("component_id")))
            .groupBy("component_id").agg(F.min("_key").alias("_least_key"))
            .select(F.col("component_id").alias("_of"), "_least_key")
        )
        others = found.join(least, F.col("component_id").eqNullSafe(F.col("_of"))).where(
            ~(F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_key") == F.col("_least_key")))
        )
        others = small_side(store(others.select("_id", "_key").distinct(), "others"))
        text = F.coalesce(df[text_col].cast("string"), F.lit(""))
        same = df[id_col].eqNullSafe(others["_id"]) & (text_key(text) == others["_key"])
        kept = df.join(others, same, "left_anti")
        # Rows of documents without words may share both; they are left alone.
        if found.groupBy("_id", "_key").count().where("count > 1").isEmpty():
            return kept
    wordless = ~F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return kept.where(wordless).unionByName(
        kept.where(~wordless).dropDuplicates([id_col, text_col])
    )
