"""Repeated byte strings: sampled suffixes in q-gram buckets, refined by what follows and precedes.

Every byte string of ``length`` bytes belongs to the least q-gram in it (by hash,
the leftmost of equal ones), its anchor. Equal strings have equal anchors at the
same offset, so it is enough to compare the suffixes that start at anchors:
about two in ``length - q`` positions. The strings of one anchor are a range of
offsets; their bucket is the q-gram. A bucket is refined by the identifier of
the whole stretch that the range covers. Anchors whose stretches are equal share
one identifier, and from then on one of them stands for all. Where a bucket
still has several identifiers, its ranges of offsets are cut into seven, the
bucket of a part is what all its strings have in common, and the refinement goes
on with those parts, until a part is one string.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ID, TEXT, Powers, as_bytes, map_batches, mix, narrow, salted, slices, store

# A range of offsets is cut into so many parts.
FAN_OUT = 7
# Which anchors go on is known by a bitmap of this many bits: 8 MB, whatever the input.
BITMAP_BITS = 1 << 26
# Long texts are worked on in pieces of so many strings.
PIECE = 1 << 18

_CORE = salted(256, 11), Powers(0x2545F4914F6CDD1D)
_WHOLE = salted(256, 12), Powers(0x9FB21C651E98DF25)


class _Hashes:
    """Hashes of any ranges of a buffer, by one of two families."""

    def __init__(self, buffer: np.ndarray, family) -> None:
        table, powers = family
        direct, self.inverse = powers.upto(max(len(buffer) + 1, PIECE + 4096))
        self.sums = np.zeros(len(buffer) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(table[buffer] * direct[:len(buffer)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            value = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
            return mix(value ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row, by running minima inside blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def anchors(texts: list[bytes], length: int, q: int):
    """Per anchor of each text: (text, position, least and greatest offset, core, whole, buffer, at).

    Yields arrays, one set per piece of work. Offsets are from a string's start
    to its anchor. ``at`` is the anchor's place in ``buffer``.
    """
    pieces: list[tuple[int, int, int]] = []  # text, first string, number of strings

    def work():
        parts = [texts[t][x:x + count + length - 1] for t, x, count in pieces]
        buffer = np.frombuffer(b"".join(parts), np.uint8)
        begins = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]])
        core = _Hashes(buffer, _CORE)
        places = np.arange(len(buffer) - q + 1)
        grams = core.of(places, places + q)
        # The upper half of the hash decides, then the position.
        keys = (grams >> np.uint64(32) << np.uint64(32)) | places.astype(np.uint64)
        least = (_sliding_min(keys, length - q + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        counts = [count for _, _, count in pieces]
        strings = np.concatenate([np.arange(b, b + c) for b, c in zip(begins.tolist(), counts)])
        piece = np.repeat(np.arange(len(pieces)), counts)
        anchor = least[strings]
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(strings)) - 1
        low, high, at, of = strings[first], strings[last], anchor[first], piece[first]
        text = np.array([t for t, _, _ in pieces])[of]
        position = at - begins[of] + np.array([x for _, x, _ in pieces])[of]
        whole = _Hashes(buffer, _WHOLE).of(low, high + length)
        return text, position, at - high, at - low, grams[at], whole, buffer, at

    size = 0
    for t, text in enumerate(texts):
        total = len(text) - length + 1
        for x in range(0, max(total, 0), PIECE):
            count = min(PIECE, total - x)
            if pieces and size + count + length > PIECE + length:
                yield work()
                pieces, size = [], 0
            pieces.append((t, x, count))
            size += count + length
    if pieces:
        yield work()


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))


def _range(v1: np.ndarray, v2: np.ndarray) -> np.ndarray:
    return (v1.astype(np.int64) << 32) | v2.astype(np.int64)


def _anchor_rows(df: DataFrame, length: int, q: int) -> DataFrame:
    def rows(batches):
        for batch in batches:
            docs = batch.column("_doc").to_numpy()
            texts = as_bytes(batch.column(TEXT))
            for begin, end in slices(texts):
                for text, at, v1, v2, core, whole, _, _ in anchors(texts[begin:end], length, q):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs[begin:end][text]), _long(at), _long(_range(v1, v2)),
                         _long(core), _long(whole)],
                        ["doc", "at", "offsets", "core", "whole"],
                    )

    return map_batches(df, rows, "doc long, at long, offsets long, core long, whole long")


def _bit(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = mix(doc.view(np.uint64) + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (mixed & np.uint64(BITMAP_BITS - 1)).astype(np.int64)


def _bitmap(wanted: DataFrame) -> np.ndarray:
    """One bit per wanted anchor's hash, in a table of fixed size."""

    def rows(batches):
        for batch in batches:
            bits = np.unique(_bit(batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bits >> 6), pa.array(np.left_shift(np.int64(1), bits & 63))],
                ["word", "bits"],
            )

    words = map_batches(wanted.select("doc", "at"), rows, "word long, bits long")
    bitmap = np.zeros(BITMAP_BITS // 64, np.int64)
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return bitmap


def _stretches(df: DataFrame, wanted: DataFrame, length: int, q: int) -> DataFrame:
    """The bytes of the stretches of wanted anchors."""
    bitmap = df.sparkSession.sparkContext.broadcast(_bitmap(wanted))

    def rows(batches):
        bits = bitmap.value
        for batch in batches:
            docs = batch.column("_doc").to_numpy()
            texts = as_bytes(batch.column(TEXT))
            for begin, end in slices(texts):
                for text, at, v1, v2, _, _, buffer, place in anchors(texts[begin:end], length, q):
                    doc = docs[begin:end][text]
                    bit = _bit(doc, at)
                    take = np.flatnonzero((bits[bit >> 6] >> (bit & 63)) & 1)
                    if len(take) == 0:
                        continue
                    lows, highs = (place - v2)[take], (place - v1)[take] + length
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc[take]), _long(at[take]), _long(_range(v1, v2)[take]),
                         pa.array([buffer[a:b].tobytes() for a, b in
                                   zip(lows.tolist(), highs.tolist())], pa.binary())],
                        ["doc", "at", "offsets", "stretch"],
                    )

    made = map_batches(df, rows, "doc long, at long, offsets long, stretch binary")
    # The bitmap lets a few others through.
    keys = ["doc", "at", "offsets"]
    return made.dropDuplicates(keys).join(wanted.select(*keys, "alone"), keys)


def _parts(level_width: int, length: int):
    """For stretches with the offsets still in question: one row per part of the range of offsets."""

    def rows(batches):
        for batch in batches:
            doc, at, offsets, alone, low, high = (
                batch.column(c).to_numpy(zero_copy_only=False)
                for c in ("doc", "at", "offsets", "alone", "low", "high")
            )
            stretches = as_bytes(batch.column("stretch"))
            for begin, end in slices(stretches, PIECE):
                buffer = np.frombuffer(b"".join(stretches[begin:end]), np.uint8)
                sizes = np.array([len(s) for s in stretches[begin:end]])
                begins = np.cumsum(sizes) - sizes
                lo, hi = low[begin:end], high[begin:end]
                first, last = lo // level_width, hi // level_width
                each = last - first + 1
                row = np.repeat(np.arange(end - begin), each)
                part = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + first[row]
                v1 = np.maximum(part * level_width, lo[row])
                v2 = np.minimum((part + 1) * level_width - 1, hi[row])
                # A stretch starts at its greatest offset before the anchor.
                place = begins[row] + (offsets[begin:end] & 0xFFFFFFFF)[row]
                # All strings of a part hold what lies from its least to its greatest offset.
                core = _Hashes(buffer, _CORE).of(
                    place - part * level_width,
                    place - ((part + 1) * level_width - 1) + length,
                )
                whole = _Hashes(buffer, _WHOLE).of(place - v2, place - v1 + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[begin:end][row]), _long(at[begin:end][row]),
                     pa.array(offsets[begin:end][row]), _long(_range(v1, v2)),
                     pa.array(alone[begin:end][row]), _long(part), _long(core), _long(whole)],
                    ["doc", "at", "offsets", "range", "alone", "part", "core", "whole"],
                )

    return rows


def _classes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per bucket and identifier, with one that stands for all."""
    return store(
        rows.groupBy(*keys).agg(
            F.count("*").alias("_rows"), F.min(F.struct("doc", "at", "offsets", "alone")).alias("_one")
        ), "classes",
    )


def _in_mixed_buckets(classes: DataFrame, bucket: list[str]) -> DataFrame:
    """Of buckets with several identifiers, the row that stands for each."""
    several = (
        classes.groupBy(*bucket)
        .agg(F.count("*").alias("_ids"), F.max((F.col("_rows") == 1) & F.col("_one.alone")).alias("_open"))
        .where("_ids > 1 and _open")
        .select(*[F.col(b).alias(f"_{b}") for b in bucket])
    )
    several = store(several, "buckets")
    same = [F.col(b) == F.col(f"_{b}") for b in bucket]
    return classes.join(several, same)


def _spans(rows: DataFrame, classes: DataFrame, keys: list[str], offsets: str, length: int):
    """The bytes of strings that were found to be repeated."""
    twice = classes.where("_rows > 1").select(*[F.col(k).alias(f"_{k}") for k in keys])
    found = rows.where("alone").join(twice, [F.col(k) == F.col(f"_{k}") for k in keys])
    low, high = F.shiftright(offsets, 32), F.col(offsets).bitwiseAND(0xFFFFFFFF)
    return found.select(
        "doc", (F.col("at") - high).alias("start"), (F.col("at") - low + length).alias("end")
    )


def repeated_spans(df: DataFrame, length: int, q: int) -> DataFrame:
    """``doc, start, end`` of bytes covered by repeated strings; they may overlap.

    The table needs ``_doc`` (a long) and the text. Rows with the same number
    are occurrences of their own.
    """
    rows = store(_anchor_rows(df, length, q).withColumn("alone", F.lit(True)), "anchors")
    keys = ["core", "offsets", "whole"]
    classes = _classes(rows, keys)
    spans = [store(_spans(rows, classes, keys, "offsets", length), "spans")]
    # From here on one row stands for a class; ``alone``: not known to be repeated so far.
    going_on = store(
        _in_mixed_buckets(classes, ["core"]).select(
            "_one.doc", "_one.at", "_one.offsets", (F.col("_rows") == 1).alias("alone")
        ), "going_on",
    )
    stretches = store(_stretches(df, going_on, length, q).drop("alone"), "stretches")
    active = going_on.select(
        "doc", "at", "offsets", "alone", F.shiftright("offsets", 32).alias("low"),
        F.col("offsets").bitwiseAND(0xFFFFFFFF).alias("high"),
    )
    width = length - q + 1
    while width > 1:
        width = -(-width // FAN_OUT)
        parts = stretches.join(active, ["doc", "at", "offsets"])
        rows = store(
            map_batches(
                parts, _parts(width, length),
                "doc long, at long, offsets long, range long, alone boolean, part long, core long, whole long",
            ), "parts",
        )
        keys = ["core", "part", "range", "whole"]
        classes = _classes(rows, keys)
        spans.append(store(_spans(rows, classes, keys, "range", length), "spans"))
        active = store(
            _in_mixed_buckets(classes, ["core", "part"]).select(
                "_one.doc", "_one.at", "_one.offsets",
                ((F.col("_rows") == 1) & F.col("_one.alone")).alias("alone"),
                F.shiftright("range", 32).alias("low"),
                F.col("range").bitwiseAND(0xFFFFFFFF).alias("high"),
            ), "active",
        )
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, maximal runs of half-open spans."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def remove_repeated(
    df: DataFrame, length: int = 400, q: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Remove each byte covered by a string of ``length`` bytes that also starts anywhere else.

    Texts are UTF-8 bytes and matches never cross documents; other occurrences
    may be in the same document and may overlap. All strings are judged on the
    input. Returns one row per input row: ``_id, n_bytes, n_removed, n_spans``
    (maximal removed runs), ``kept`` (the bytes left, binary), ``kept_sha256``.

    Strings are compared by two 64-bit hashes, documents told apart by one. A
    NULL text is empty; a text shorter than ``length`` loses nothing. Repeated
    rows, also of the same id, are occurrences of their own, so they are removed
    whole. Ids may be NULL. An empty table gives an empty result. Other columns
    are ignored.
    """
    base = narrow(df, id_col, text_col).select(
        ID, TEXT, F.xxhash64(F.coalesce(F.col(ID).cast("string"), F.lit("NULL")), TEXT).alias("_doc")
    )
    spans = repeated_spans(base.select("_doc", TEXT), length, q)
    by_doc = store(
        spans.distinct().groupBy(F.col("doc").alias("_of"))
        .agg(F.collect_list(F.struct("start", "end")).alias("_spans")), "by_doc",
    )

    def rows(batches):
        for batch in batches:
            texts, spans = as_bytes(batch.column(TEXT)), batch.column("_spans")
            removed, runs, kept = [], [], []
            for text, found in zip(texts, spans):
                if not found.is_valid:
                    removed.append(0)
                    runs.append(0)
                    kept.append(text)
                    continue
                values = found.values
                cuts = merged(list(zip(values.field("start").to_pylist(),
                                       values.field("end").to_pylist())))
                at, left = 0, []
                for start, end in cuts:
                    left.append(text[at:start])
                    at = end
                left.append(text[at:])
                removed.append(sum(end - start for start, end in cuts))
                runs.append(len(cuts))
                kept.append(b"".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(ID), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(kept, pa.binary()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                [ID, "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    joined = base.join(by_doc, F.col("_doc") == F.col("_of"), "left").select(ID, TEXT, "_spans")
    kind = dict(df.select(F.col(id_col).alias(ID)).dtypes)[ID]
    return map_batches(
        joined, rows,
        f"{ID} {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string",
    )
