"""Runs of lines that occurred before are deleted, found by winnowing over line hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import SPACE, as_bytes, map_batches, mix, salted, store

_SPACE = SPACE.encode()
_COEFFICIENTS = salted(64, 21)


def _sums(hashes: np.ndarray, count: int, seed: int) -> np.ndarray:
    """A hash of each ``count`` neighbours."""
    n = max(0, len(hashes) - count + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(count):
            out += hashes[j:j + n] * _COEFFICIENTS[seed + j]
    return mix(out)


def line_windows(text: bytes, gram: int, window: int, own_words: int):
    """For each fingerprint of a text: its hash, and the runs of lines it is the least gram of.

    Of each run: where it starts, its hash, its words and those of its first line.

    A gram is ``gram`` lines in a row, a run ``gram + window - 1`` lines, that
    is ``window`` grams; the least gram of a run, the leftmost of equal ones, is
    its fingerprint. Lines are compared without white space at their ends, and
    lines without a word don't count. Runs of fewer than ``own_words`` words are left out.
    """
    lines = [line.strip(_SPACE) for line in text.split(b"\n")]
    lines = [line for line in lines if line]
    run = gram + window - 1
    if len(lines) < run:
        return
    hashes = np.array([xxhash.xxh3_64_intdigest(line) for line in lines], np.uint64)
    words = np.concatenate([[0], np.cumsum([len(line.split()) for line in lines])])
    grams = _sums(hashes, gram, 0)
    runs = _sums(hashes, run, 16)
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    least = np.arange(len(views)) + views.argmin(axis=1)
    total, head = words[run:] - words[:-run], np.diff(words)
    starts = np.flatnonzero(total >= own_words)
    chosen = least[starts]
    cuts = np.flatnonzero(np.diff(chosen)) + 1
    for group in np.split(starts, cuts):
        if len(group):
            fingerprint = int(grams[least[group[0]]].view(np.int64))
            yield fingerprint, group, runs[group].view(np.int64), total[group], head[group]


def repeated_runs(df: DataFrame, gram: int, window: int, min_words: int, own_words: int = 0) -> DataFrame:
    """``doc, from_line, to_line`` (lines with a word, from 0) of what occurred earlier.

    The table needs ``_id``, ``_doc`` (a long that tells documents with the same
    id apart) and ``_text``. Earlier is by id, then ``_doc``, then line. Runs that
    follow each other here and at their first occurrences are one match, and a
    match counts from ``min_words`` words on.
    """
    id_type = dict(df.dtypes)["_id"]
    parts = ["starts", "runs", "totals", "heads"]

    def rows(batches):
        for batch in batches:
            ids, docs = batch.column("_id"), batch.column("_doc").to_numpy()
            take, prints, values = [], [], [[] for _ in parts]
            for at, text in enumerate(as_bytes(batch.column("_text"))):
                for fingerprint, *of_runs in line_windows(text, gram, window, own_words):
                    take.append(at)
                    prints.append(fingerprint)
                    for kept, value in zip(values, of_runs):
                        kept.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints, pa.int64()), ids.take(pa.array(take, pa.int64())),
                 pa.array(docs[take] if take else [], pa.int64()),
                 *[pa.array(kept, pa.list_(pa.int64())) for kept in values]],
                ["print", "id", "doc", *parts],
            )

    prints = store(
        map_batches(
            df, rows,
            f"print long, id {id_type}, doc long, " + ", ".join(f"{part} array<long>" for part in parts),
        ), "fingerprints",
    )
    # Positions of fingerprints found more than once ...
    twice = store(
        prints.groupBy(F.col("print").alias("_print"))
        .agg(F.sum(F.size("starts")).alias("_n")).where("_n > 1").select("_print"), "twice",
    )
    # ... and around each of them the runs it belongs to: matches extend as far as runs agree.
    runs = store(
        prints.join(twice, F.col("print") == F.col("_print"))
        .select("print", "id", "doc", F.explode(F.arrays_zip(*parts)).alias("_run"))
        .select("print", "id", "doc", F.col("_run.starts").alias("start"), F.col("_run.runs").alias("run"),
                F.col("_run.totals").alias("total"), F.col("_run.heads").alias("head")),
        "runs",
    )
    firsts = store(
        runs.groupBy(F.col("print").alias("_print"), F.col("run").alias("_run"))
        .agg(F.min(F.struct("id", "doc", "start")).alias("first"), F.count("*").alias("_n"))
        .where("_n > 1").drop("_n"), "firsts",
    )
    lines = gram + window - 1
    found = runs.join(
        firsts, (F.col("print") == F.col("_print")) & (F.col("run") == F.col("_run"))
    )
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("doc") == F.col("first.doc"))
    # What overlaps the first occurrence belongs to it.
    begin = F.when(same, F.greatest("start", F.col("first.start") + lines)).otherwise(F.col("start"))
    later = (
        found.where(~(same & (F.col("start") == F.col("first.start"))))
        .select("doc", "start", "total", "head", begin.alias("begin"), F.col("first.doc").alias("source"),
                (F.col("start") - F.col("first.start")).alias("shift"))
        # One partitioning by document serves what follows.
        .repartition("doc").dropDuplicates(["doc", "start"])
    )
    side = ["doc", "source", "shift"]
    stretches = later.withColumn(
        "stretch", F.col("start") - F.row_number().over(Window.partitionBy(*side).orderBy("start"))
    )
    last = F.max(F.struct("start", "total", "head"))
    return (
        stretches.groupBy(*side, "stretch")
        .agg(F.min("begin").alias("from_line"), F.sum("head").alias("_heads"), last.alias("_last"))
        .where(F.col("_heads") - F.col("_last.head") + F.col("_last.total") >= min_words)
        .select("doc", "from_line", (F.col("_last.start") + lines).alias("to_line"))
    )


def dedup_lines(
    df: DataFrame,
    gram: int = 1,
    window: int = 2,
    min_words: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    single_words: int | None = None,
) -> DataFrame:
    """Delete from every text the runs of lines that occurred earlier, and add two counts.

    A run of at least ``gram + window - 1`` lines that also occurs earlier (by
    id, then line, in the same or another text) shares a fingerprint with that
    occurrence, whatever surrounds it. Every run around a repeated fingerprint
    is compared with the first run like it; runs that follow each other in both
    places make longer matches, and matches of ``min_words`` words or more are
    deleted where they occur later, however short their lines. With
    ``single_words``, every line of at least so many words that occurred earlier
    is deleted too, whatever its neighbours; without, a line that is not part of
    a longer run stays, however common. All lines are judged on the input. ``n_lines``: lines of the text;
    ``n_deleted``: lines deleted. Lines without a word are never deleted.

    A NULL text stays NULL (one line of no words, as an empty text); NULL ids
    come first. Rows that share both id and text are one document: they lose the
    same lines, and none to each other. An empty table gives an empty result.
    All columns stay; columns named like the counts are replaced. Lines and runs
    are compared by 64-bit hashes.
    """
    added = ["n_lines", "n_deleted"]
    names = [c for c in df.columns if c not in added]
    # By number, so that no name of the caller's can clash with one of the join's.
    base = df.select([F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    text = F.col(f"`{text_col}`")
    key = F.xxhash64(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("NULL")), text)
    keyed = df.select(F.col(f"`{id_col}`").alias("_id"), key.alias("_doc"), text.alias("_text"))
    found = repeated_runs(keyed, gram, window, min_words)
    if single_words is not None:
        found = found.unionByName(repeated_runs(keyed, 1, 1, single_words, own_words=single_words))
    cuts = store(
        found.where("from_line < to_line").distinct().groupBy(F.col("doc").alias("_of"))
        .agg(F.collect_list(F.struct("from_line", "to_line")).alias("_cuts")), "cuts",
    )
    at_text = names.index(text_col)
    own = F.xxhash64(
        F.coalesce(F.col(f"c{names.index(id_col)}").cast("string"), F.lit("NULL")), f"c{at_text}"
    )
    joined = base.withColumn("_doc", own).join(
        # The cuts grow with the texts: never broadcast.
        cuts.hint("merge"), F.col("_doc") == F.col("_of"), "left"
    )
    joined = joined.drop("_doc", "_of")
    fields = [df.schema[name] for name in names]
    fields[at_text] = StructField(text_col, StringType(), True)
    schema = StructType(
        [StructField(f.name, f.dataType, True) for f in fields]
        + [StructField(name, LongType(), True) for name in added]
    )

    def rows(batches):
        for batch in batches:
            texts, cuts = batch.column(at_text), batch.column(len(fields))
            out, counts, deleted = [], [], []
            for text, cut in zip(texts.to_pylist(), cuts):
                lines = (text or "").split("\n")
                counts.append(len(lines))
                if not cut.is_valid:
                    out.append(text)
                    deleted.append(0)
                    continue
                with_word = [i for i, line in enumerate(lines) if line.strip(SPACE)]
                gone = np.zeros(len(with_word) + 1, np.int64)
                values = cut.values
                np.add.at(gone, values.field("from_line").to_numpy(), 1)
                np.add.at(gone, values.field("to_line").to_numpy(), -1)
                drop = {with_word[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] > 0).tolist()}
                out.append("\n".join(line for i, line in enumerate(lines) if i not in drop))
                deleted.append(len(drop))
            columns = batch.columns[:len(fields)]
            columns[at_text] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(counts, pa.int64()), pa.array(deleted, pa.int64())],
                [f.name for f in schema.fields],
            )

    return map_batches(joined, rows, schema)
