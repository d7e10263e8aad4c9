"""Hard negatives by an inverted multi-index: exact windows of scores, found cell by cell.

Vectors are cut into two halves, each with a codebook of its own; a row lies in
the cell of its two codewords. For an anchor, no half of a row scores more than its codeword does plus
the anchor's length times the codeword's radius, so the sum of two half bounds
bounds a cell. A heap visits an anchor's cells in the order of these sums, without
listing them all, and an anchor is done when the next sum can't change its result.

Spark holds the index, one row per vector by cell. The search goes in rounds: every open
anchor's heap names its next cells, visits and rows meet by cell, and what was
found sets the bar for the round after. Blocks of a cell's rows and blocks of
its visitors meet one at a time, so a crowded cell is many small tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from math import ceil, sqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, ship, store

# Rows that the codebooks are fitted on, chosen by hash; every row is indexed.
SAMPLE_ROWS = 8_192
# Codewords of a half: cells hold about so many rows, up to the most codewords.
CELL_ROWS = 256
MOST_CODEWORDS = 256
# Rows and visitors of a cell that meet in one step.
BLOCK_ROWS = 4_096
BLOCK_VISITORS = 1_024
# Rows that an anchor's first round reaches, and how much more each further one does.
FIRST_ROWS = 4_096
GROWTH = 8


class Codebooks(NamedTuple):
    """Codewords of both halves, the radius around each, and the rows of each cell."""

    words: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    sizes: np.ndarray
    width: int

    @property
    def half(self) -> int:
        return (self.width + 1) // 2


def vectors(raw: list[bytes], width: int) -> np.ndarray:
    """Stored vectors as rows of a matrix; what a shorter one lacks is 0."""
    lengths = {len(r) for r in raw}
    if lengths <= {4 * width}:
        return np.frombuffer(b"".join(raw), "<i4").reshape(len(raw), width)
    out = np.zeros((len(raw), width), np.int32)
    for at, r in enumerate(raw):
        out[at, :len(r) // 4] = np.frombuffer(r, "<i4")
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * a.shape[1]
    if most < 2**53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    if most < 2**63:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    return (a.astype(object) @ b.T.astype(object)).astype(np.int64)


def nearest(points: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codeword next to each point, and how far it is."""
    code = np.empty(len(points), np.int64)
    for at in range(0, len(points), 4096):
        part = points[at:at + 4096]
        code[at:at + 4096] = ((words**2).sum(1) - 2 * part @ words.T).argmin(1)
    return code, np.sqrt(((points - words[code]) ** 2).sum(1))


def fit(points: np.ndarray, count: int, rounds: int = 10) -> np.ndarray:
    """Codewords by k-means, started from points spread over the sample."""
    points = np.unique(points, axis=0)
    words = points[np.random.default_rng(11).permutation(len(points))[:count]]
    for _ in range(rounds):
        code, _ = nearest(points, words)
        sums = np.zeros_like(words)
        np.add.at(sums, code, points)
        rows = np.bincount(code, minlength=len(words))
        words = np.where(rows[:, None] > 0, sums / np.maximum(rows, 1)[:, None], words)
    return words


def half_bounds(books: Codebooks, anchor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each half: the least and the greatest score of a row with each codeword."""
    out = []
    for part, words, radii in zip((anchor[:books.half], anchor[books.half:]), books.words, books.radii):
        middle, reach = words @ part, sqrt(float((part**2).sum())) * radii
        # Whole scores are compared with these; they err on the safe side.
        reach = reach + 1e-9 * (np.abs(middle) + reach) + 1e-6
        out.append((middle - reach, middle + reach))
    return out


def cells_by_bound(one: np.ndarray, two: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """All pairs of two lists' places, by the sum of what stands there, the greatest first."""
    first, second = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
    a, b = one[first].tolist(), two[second].tolist()
    heap = [(-(a[0] + b[0]), 0, 0)] if a and b else []
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, int(first[i]), int(second[j])
        if j + 1 < len(b):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))


def next_cells(books: Codebooks, anchor: np.ndarray, visited: int, rows: int, bar: float, ceiling: float):
    """The anchor's next cells after those visited, how many that makes, and whether it is done then.

    Cells come until they hold so many rows. Done is an anchor when the next cell can't reach the bar.
    A cell whose rows are all above the ceiling is passed over.
    """
    (low1, high1), (low2, high2) = half_bounds(books, anchor)
    cells, reached, at = [], 0, 0
    for bound, i, j in cells_by_bound(high1, high2):
        if bound < bar:
            return cells, at, True
        at += 1
        if at <= visited:
            continue
        size = int(books.sizes[i, j])
        if size and low1[i] + low2[j] <= ceiling:
            cells.append(i * books.sizes.shape[1] + j)
            reached += size
            if reached >= rows:
                return cells, at, False
    return cells, at, True


def best(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the greatest scores, smaller ids first where they are equal."""
    at = np.arange(len(scores))
    if len(at) > count:
        least = np.partition(scores, len(at) - count)[len(at) - count]
        at = np.flatnonzero(scores >= least)
    return at[np.lexsort((ids[at], -scores[at]))][:count]


def _prepared(df: DataFrame, anchors: Column, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Rows that take part: id, label, the whole-number vector in 32-bit pieces, and whether it is an anchor."""
    vector = F.col(vector_col)
    fit_to_use = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & vector.isNotNull() & fit_to_use)
    rows = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        vector.cast("array<double>").alias("x"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
    )

    def whole(batches):
        for batch in batches:
            lists = batch.column("x")
            flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False))
            if len(flat) and np.abs(flat).max() >= 2**31:
                raise ValueError("a component is too large: its multiple must lie within 32 bits")
            flat = flat.astype("<i4")
            ends = np.cumsum(np.array([len(v) for v in lists], np.int64))
            raw = [v.tobytes() for v in np.split(flat, ends[:-1])] if len(batch) else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(raw, pa.binary()), batch.column("is_anchor")],
                ["id", "label", "v", "is_anchor"],
            )

    made = map_batches(rows, whole, "id long, label long, v binary, is_anchor boolean")
    return store(made.withColumn("row", F.monotonically_increasing_id()), "vectors")


def _codebooks(rows: DataFrame, count: int, width: int, codewords: int | None) -> tuple[np.ndarray, np.ndarray]:
    chosen = F.pmod(F.xxhash64("row", "id"), F.lit(1 << 30)) < int(min(1.0, SAMPLE_ROWS / max(count, 1)) * (1 << 30))
    sample = vectors([bytes(r.v) for r in rows.where(chosen).limit(2 * SAMPLE_ROWS).select("v").collect()], width)
    if not len(sample):
        sample = np.zeros((1, width), np.int32)
    if codewords is None:
        codewords = min(MOST_CODEWORDS, max(2, ceil(sqrt(count / CELL_ROWS))))
    half = (width + 1) // 2
    return fit(sample[:, :half].astype(float), codewords), fit(sample[:, half:].astype(float), codewords)


def build_index(rows: DataFrame, codewords: int | None = None) -> tuple[Codebooks, DataFrame]:
    """Codebooks fitted on a sample, and every row with its cell and its block in it.

    To the driver come the sample (``SAMPLE_ROWS`` vectors or so) and one row per cell, whose
    number the codewords bound.
    """
    count, width = rows.agg(F.count("*"), F.max(F.octet_length("v"))).first()
    width = (width or 0) // 4
    words = _codebooks(rows, count, width, codewords)
    half, across = (width + 1) // 2, len(words[1])

    def placed(batches):
        for batch in batches:
            v = vectors(batch.column("v").to_pylist(), width).astype(float)
            one, far1 = nearest(v[:, :half], words[0])
            two, far2 = nearest(v[:, half:], words[1])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("row", "id", "label", "v", "is_anchor")],
                 pa.array(one * across + two), pa.array(far1), pa.array(far2)],
                ["row", "id", "label", "v", "is_anchor", "cell", "far1", "far2"],
            )

    schema = "row long, id long, label long, v binary, is_anchor boolean, cell long, far1 double, far2 double"
    indexed = store(map_batches(rows, placed, schema), "cells")
    sizes = np.zeros((len(words[0]), across), np.int64)
    radii = np.zeros(len(words[0])), np.zeros(across)
    for cell, n, far1, far2 in indexed.groupBy("cell").agg(F.count("*"), F.max("far1"), F.max("far2")).collect():
        i, j = divmod(cell, across)
        sizes[i, j] = n
        radii[0][i], radii[1][j] = max(radii[0][i], far1), max(radii[1][j], far2)
    return Codebooks(words, radii, sizes, width), indexed.drop("far1", "far2")


def _visits(state: DataFrame, books, rows: int) -> DataFrame:
    """Per open anchor: its next cells, and a row without a cell that says how far it got."""

    def named(batches):
        for batch in batches:
            anchors, cells, visited, done = [], [], [], []
            columns = [batch.column(c).to_pylist() for c in ("anchor", "v", "visited", "bar", "ceiling")]
            matrix = vectors(columns[1], books.value.width).astype(float)
            for at, (anchor, _, before, bar, ceiling) in enumerate(zip(*columns)):
                found, upto, is_done = next_cells(
                    books.value, matrix[at], before, rows,
                    -np.inf if bar is None else bar, np.inf if ceiling is None else ceiling,
                )
                anchors += [anchor] * (len(found) + 1)
                cells += [*found, None]
                visited += [None] * len(found) + [upto]
                done += [None] * len(found) + [is_done]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors, pa.int64()), pa.array(cells, pa.int64()), pa.array(visited, pa.int64()),
                 pa.array(done, pa.bool_())], ["anchor", "cell", "visited", "done"],
            )

    asked = state.select("anchor", "v", "visited", "bar", "ceiling")
    return store(map_batches(asked, named, "anchor long, cell long, visited long, done boolean"), "visits")


def _meet(visits: DataFrame, state: DataFrame, indexed: DataFrame, width: int, pick: Callable, carried: list[str]):
    """What ``pick`` takes from the scores of each anchor against the rows of the cells it visits.

    Of a cell's rows and of its visitors, one block each meet at a time.
    """
    rows_of = indexed.groupBy(F.col("cell").alias("_cell")).agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("_blocks"))
    asked = visits.where(F.col("cell").isNotNull())
    cells = asked.groupBy(F.col("cell").alias("_cell")).agg(
        F.ceil(F.count("*") / BLOCK_VISITORS).alias("_groups")
    ).join(rows_of, "_cell")
    # One row per cell, whose number the codewords bound.
    cells = F.broadcast(store(cells, "visited_cells"))

    def every(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1))

    rows = (
        indexed.join(cells, F.col("cell") == F.col("_cell"))
        .withColumn("block", F.pmod(F.xxhash64("row"), F.col("_blocks")))
        .withColumn("group", every("_groups"))
        .select("cell", "block", "group", "id", "label", "v")
    )
    askers = (
        asked.select("anchor", "cell").join(state.select("anchor", "id", "label", "v", *carried), "anchor")
        .join(cells, F.col("cell") == F.col("_cell"))
        .withColumn("group", F.pmod(F.xxhash64("anchor"), F.col("_groups")))
        .withColumn("block", every("_blocks"))
        .drop("_cell", "_blocks", "_groups")
    )
    kind = pa.schema([("anchor", pa.int64()), ("found", pa.int64()), ("score", pa.int64())])

    def together(rows: pa.Table, askers: pa.Table) -> pa.Table:
        out = [[], [], []]
        if rows.num_rows and askers.num_rows:
            ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
            matrix = vectors(rows.column("v").to_pylist(), width)
            for at in range(0, askers.num_rows, 256):
                part = askers.slice(at, 256)
                scores = products(vectors(part.column("v").to_pylist(), width), matrix)
                for asker, line in zip(part.drop_columns(["v"]).to_pylist(), scores):
                    chosen = pick(asker, line, ids, labels)
                    out[0].append(np.full(len(chosen), asker["anchor"], np.int64))
                    out[1].append(ids[chosen])
                    out[2].append(line[chosen])
        return pa.table([np.concatenate(c) if c else np.empty(0, np.int64) for c in out], schema=kind)

    keys = ["cell", "block", "group"]
    ship(indexed.sparkSession)
    pairs = rows.groupBy(keys).cogroup(askers.groupBy(keys))
    return pairs.applyInArrow(together, "anchor long, found long, score long")


def _search(state: DataFrame, indexed: DataFrame, books, pick, carried: list[str], keep) -> DataFrame:
    """Rounds until every anchor is done. ``keep`` says what stays of the found rows, and the new bars.

    ``state`` has the open anchors: anchor, id, label, v, bar, ceiling and ``carried``. Every round reaches
    ``GROWTH`` times as many rows, so their number grows with the logarithm of the rows.
    """
    spark = state.sparkSession
    found = spark.createDataFrame([], "anchor long, found long, score long")
    open_, rows = state.withColumn("visited", F.lit(0).cast("long")), FIRST_ROWS
    while True:
        open_ = store(open_, "open")
        if open_.isEmpty():
            return found
        visits = _visits(open_, books, rows)
        new = _meet(visits, open_, indexed, books.value.width, pick, carried)
        found, bars = keep(found.unionByName(new), open_)
        still = visits.where("not done").select("anchor", F.col("visited").alias("_visited"))
        open_ = open_.join(still, "anchor").withColumn("visited", F.col("_visited")).drop("_visited")
        open_ = open_.drop("bar", *[c for c in bars.columns if c != "anchor"]).join(bars, "anchor", "left")
        rows *= GROWTH


def _nearest_of_label(anchors: DataFrame, indexed: DataFrame, books, count: int) -> DataFrame:
    """The best rows of each anchor's own label: anchor, found, score."""

    def pick(asker, scores, ids, labels):
        bar = asker["bar"]
        at = np.flatnonzero((labels == asker["label"]) & (ids != asker["id"]))
        if bar is not None:
            at = at[scores[at] >= bar]
        return at[best(scores[at], ids[at], count)]

    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "found")

    def keep(found, open_):
        found = store(found.withColumn("_r", F.row_number().over(first)).where(f"_r <= {count}").drop("_r"), "positives")
        full = found.groupBy("anchor").agg(F.count("*").alias("_n"), F.min("score").cast("double").alias("bar"))
        return found, full.where(f"_n = {count}").drop("_n")

    state = anchors.withColumns({"bar": F.lit(None).cast("double"), "ceiling": F.lit(None).cast("double")})
    return _search(state, indexed, books, pick, ["bar"], keep)


def _in_windows(anchors: DataFrame, windows: DataFrame, indexed: DataFrame, books, count: int) -> DataFrame:
    """The best rows of other labels in each window [low, high] of scores: anchor, found, score.

    ``windows`` has a row per anchor and window.
    """

    def pick(asker, scores, ids, labels):
        other = np.flatnonzero((labels != asker["label"]) & (ids != asker["id"]))
        chosen = []
        for window in asker["windows"]:
            at = other[(scores[other] >= window["bar"]) & (scores[other] <= window["high"])]
            chosen.append(at[best(scores[at], ids[at], count)])
        return np.unique(np.concatenate(chosen))

    listed = F.collect_list(F.struct("low", "high", "bar")).alias("windows")
    limits = [listed, F.min("bar").cast("double").alias("bar"), F.max("high").cast("double").alias("ceiling")]
    best_first = Window.partitionBy("anchor", "high", "low").orderBy(F.desc("score"), "found")

    def keep(found, open_):
        # A row that two windows want was found twice, or in an earlier round.
        found = store(found, "in_windows")
        mine = open_.select("anchor", F.inline("windows")).drop("bar")
        ranked = found.join(mine, "anchor").where("score between low and high")
        ranked = ranked.withColumn("_r", F.row_number().over(best_first)).where(f"_r <= {count}")
        ranked = store(ranked, "ranked")
        full = ranked.where(f"_r = {count}").select(
            F.col("anchor").alias("_a"), F.col("low").alias("_l"), F.col("high").alias("_h"), F.col("score").alias("_bar")
        )
        same = (F.col("anchor") == F.col("_a")) & (F.col("low") == F.col("_l")) & (F.col("high") == F.col("_h"))
        raised = mine.join(full, same, "left").withColumn("bar", F.coalesce("_bar", "low"))
        return found, raised.groupBy("anchor").agg(*limits)

    state = windows.withColumn("bar", F.col("low")).groupBy("anchor").agg(*limits)
    return _search(anchors.join(state, "anchor"), indexed, books, pick, ["windows"], keep)


def mine_hard_negatives(
    df: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    scale: int = 256,
    codewords: int | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Rows of other labels that score nearly as high as an anchor's best rows of its own label.

    A component x counts as floor(scale * x), a score is the inner product with the
    anchor; higher scores come first, then smaller ids. For each row that ``anchors`` holds for, and each of its
    first ``positives`` rows of the same label, the first ``negatives`` rows of other labels
    with ``low_percent`` to ``high_percent`` of the positive's score:
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. Exact:
    an anchor's search ends only when no unvisited cell can hold a row that belongs in the result.

    Rows with a NULL id, label, vector or component, or a component that is not finite, take no part.
    Components from 2^31 / scale on end the job, scores beyond 64 bits too. In a vector shorter than the longest
    the missing components are 0. Rows that share an id with the anchor are not compared with it;
    other rows that share an id count one by one, equal anchors once. A positive without
    negatives has no rows, nor has one with a negative score (its window is empty). An
    empty table gives an empty result; other columns are ignored.
    """
    rows = _prepared(df, anchors, scale, id_col, vector_col, label_col)
    codebooks, indexed = build_index(rows, codewords)
    books = df.sparkSession.sparkContext.broadcast(codebooks)
    chosen = indexed.where("is_anchor").groupBy("id", "label", "v").agg(F.min("row").alias("anchor"))
    chosen = store(chosen, "anchors")
    near = store(
        _nearest_of_label(chosen, indexed, books, positives).select(
            "anchor", F.col("found").alias("positive_id"), F.col("score").alias("positive_score")
        ), "positives",
    )
    hundred = F.col("positive_score")
    windows = near.select(
        "anchor",
        F.ceil((hundred * low_percent).cast("decimal(38,0)") / 100).cast("long").alias("low"),
        F.floor((hundred * high_percent).cast("decimal(38,0)") / 100).cast("long").alias("high"),
    ).where("low <= high").distinct()
    found = _in_windows(chosen, store(windows, "windows"), indexed, books, negatives)
    pairs = near.join(found, "anchor").where(
        (F.col("score") * 100 >= hundred * low_percent) & (F.col("score") * 100 <= hundred * high_percent)
    )
    by_score = Window.partitionBy("anchor", "positive_id", "positive_score").orderBy(F.desc("score"), "found")
    ranked = pairs.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= negatives)
    return ranked.join(chosen.select("anchor", F.col("id").alias("anchor_id")), "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("found").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
