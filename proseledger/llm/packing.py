"""Documents packed into as few token sequences as possible, with certified lower bounds."""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ID, TEXT, map_batches, narrow, slices, store

END_ID = 0
# Fixed value: how byte-level BPE cuts a text before merging.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Pieces packed by one task.
ITEMS_PER_PART = 50_000
# A sequence with at most this share of its places empty stays as it is.
CLOSED_WASTE = 0.005
# Characters whose classes (letter, number, white space) are the same in all Unicode tables in use.
_UNSETTLED = re.compile(r"[^\x00-\u0233]")
# The faster library gives up on runs of some 10^6 white-space characters.
LONGEST_SPACE = 50_000
_SPACE_RUN = re.compile(r"\s+")
_tokenizers: dict[str, tuple] = {}


def _is_plain_byte_bpe(content: dict) -> bool:
    """Whether a tokenizer file cuts by PATTERN, and merges in the order of the ids, with nothing before or between."""
    cut, model = content.get("pre_tokenizer") or {}, content["model"]
    if cut != cut | {"type": "ByteLevel", "add_prefix_space": False} or not cut.get("use_regex", True):
        return False
    if content.get("normalizer") or model.get("type") != "BPE" or any(
        model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
    ):
        return False
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [model["vocab"].get(token, -1) for token in merged]
    return ids == sorted(ids) and len(ids) == len(set(ids)) and min(ids, default=0) >= 0


def _ranks(content: dict) -> dict[bytes, int]:
    """The tokens of a byte-level BPE file as bytes: bytes that don't print stand for 256 and up."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printing]
    byte_of = {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(others)}
    added = {token["content"] for token in content["added_tokens"]}
    return {
        bytes(byte_of[c] for c in token): rank
        for token, rank in content["model"]["vocab"].items() if token not in added
    }


def encode(texts: list[str], path: str) -> list[np.ndarray]:
    """The ids of each text by the tokenizer file, without special tokens: their strings are ordinary text.

    Where the file is a plain byte-level BPE, texts of Latin letters and what goes with them are
    encoded by a faster library from the vocabulary of the same file; the tests hold it against the
    tokenizer. All other texts, and those with very long white space, go to the tokenizer itself.
    """
    if path not in _tokenizers:
        # The tasks of an executor share its cores already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        fast = None
        if _is_plain_byte_bpe(content):
            fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=_ranks(content), special_tokens={})
        _tokenizers[path] = tokenizer, fast
    tokenizer, fast = _tokenizers[path]

    def is_for_fast(text: str) -> bool:
        if fast is None or _UNSETTLED.search(text):
            return False
        return len(text) <= LONGEST_SPACE or all(
            m.end() - m.start() <= LONGEST_SPACE for m in _SPACE_RUN.finditer(text)
        )

    return [
        fast.encode_to_numpy(text, disallowed_special=())
        if is_for_fast(text)
        else np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        for text in texts
    ]


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole sequences, the first piece takes the rest."""
    first = n % capacity or capacity
    return [(0, first)] + [(start, capacity) for start in range(first, n, capacity)]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that ``counts[length]`` pieces need at least, by dual feasible functions.

    Such a function maps sizes to weights of which no full sequence holds more
    than one, so the sum of weights is a bound. Two families: sizes above
    ``capacity - k`` count as whole and those below ``k`` as nothing; and sizes
    rounded down to multiples of 1 / k out of k + 1.
    """
    sizes = np.arange(len(counts))
    counts = counts.astype(np.int64)
    best = -(-int((sizes * counts).sum()) // capacity)
    mass = np.concatenate([[0], np.cumsum(sizes * counts)])
    number = np.concatenate([[0], np.cumsum(counts)])
    half = capacity // 2

    def between(table, low, high):  # sizes low..high
        return table[np.minimum(high, len(counts) - 1) + 1] - table[np.maximum(low, 0)]

    k = np.arange(0, half + 1)
    whole = between(number, np.maximum(capacity - k, half) + 1, np.full_like(k, capacity))
    big_n = between(number, np.full_like(k, half + 1), capacity - k)
    big_mass = between(mass, np.full_like(k, half + 1), capacity - k)
    small = between(mass, k, np.full_like(k, half))
    rest = np.maximum(0, small - (big_n * capacity - big_mass))
    best = max(best, int((whole + big_n + -(-rest // capacity)).max()))
    for k in range(1, 40):
        scaled = (k + 1) * sizes
        exact = scaled % capacity == 0
        as_is = int((sizes * counts)[exact].sum())
        rounded = int(((scaled // capacity) * counts)[~exact].sum())
        best = max(best, -(-(as_is * k + rounded * capacity) // (capacity * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each piece, and the number of sequences.

    The longest pieces first, each to the fullest sequence that has room: a
    bit per free length finds it.
    """
    order = np.argsort(-lengths, kind="stable").tolist()
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    free_bits, used = 0, 0
    for at in order:
        length = int(lengths[at])
        fitting = free_bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = open_by_free[free].pop()
            if not open_by_free[free]:
                free_bits ^= 1 << free
        else:
            free, number = capacity, used
            used += 1
        sequence[at], offset[at] = number, capacity - free
        free -= length
        if free:
            open_by_free[free].append(number)
            free_bits |= 1 << free
    return sequence, offset, used


def token_pieces(
    df: DataFrame, path: str, capacity: int, id_col: str, text_col: str, with_ids: bool
) -> DataFrame:
    """Stored pieces with a row number: ``_id, piece, start, length, ids_crc32, _row`` (and ``ids``)."""
    base = narrow(df, id_col, text_col)
    ids_type = ", ids array<long>" if with_ids else ""

    def rows(batches):
        for batch in batches:
            texts = batch.column(TEXT).to_pylist()
            for begin, end in slices(texts):
                take, piece, start, length, crc, ids = [], [], [], [], [], []
                for at, found in enumerate(encode(texts[begin:end], path), begin):
                    found = np.append(found, np.uint32(END_ID)).astype("<u4")
                    for number, (first, count) in enumerate(pieces_of(len(found), capacity)):
                        part = found[first:first + count]
                        take.append(at)
                        piece.append(number)
                        start.append(first)
                        length.append(count)
                        crc.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            ids.append(part.astype(np.int64))
                columns = [batch.column(ID).take(pa.array(take, pa.int64())), pa.array(piece, pa.int32()),
                           *[pa.array(c, pa.int64()) for c in (start, length, crc)]]
                names = [ID, "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    made = map_batches(
        base, rows,
        f"{ID} {dict(base.dtypes)[ID]}, piece int, start long, length long, ids_crc32 long{ids_type}",
    )
    return store(made.withColumn("_row", F.monotonically_increasing_id()), "pieces")


def _packed(items: DataFrame, parts: int, turn: int, capacity: int) -> DataFrame:
    """Pack every part by itself: ``row, length, part, bin, offset, closed``.

    A part that needs no more sequences than its bound is closed; of the others,
    sequences that are nearly full.
    """
    most_waste = int(CLOSED_WASTE * capacity)

    def rows(batches):
        found = [b.select(["row", "length", "part"]) for b in batches]
        table = pa.Table.from_batches(found) if found else None
        if table is None or table.num_rows == 0:
            return
        row, length, part = (table.column(i).to_numpy() for i in range(3))
        order = np.lexsort((row, part))
        row, length, part = row[order], length[order], part[order]
        edges = np.flatnonzero(np.diff(part, prepend=-1)).tolist() + [len(part)]
        for begin, end in zip(edges[:-1], edges[1:]):
            sizes = length[begin:end]
            number, offset, used = best_fit_decreasing(sizes, capacity)
            bound = lower_bound(np.bincount(sizes, minlength=capacity + 1), capacity)
            if used == bound:
                closed = np.ones(end - begin, bool)
            else:
                filled = np.bincount(number, sizes)
                closed = (capacity - filled <= most_waste)[number]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[begin:end]), pa.array(sizes), pa.array(part[begin:end]),
                 pa.array(number), pa.array(offset), pa.array(closed)],
                ["row", "length", "part", "bin", "offset", "closed"],
            )

    dealt = items.withColumn("part", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(parts)))
    dealt = dealt.repartitionById(parts, F.col("part").cast("int"))
    return store(
        map_batches(dealt, rows, "row long, length long, part long, bin long, offset long, closed boolean"),
        "packed",
    )


def pack_documents(
    df: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    rounds: int = 6,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pack the tokens of all texts into sequences of at most ``capacity``.

    A document is its ids by the tokenizer file and then id 0. Longer ones are
    cut into pieces of whole sequences, the first piece taking what is over; a
    whole piece is a sequence of its own. The others are dealt to parts of
    bounded size and packed by best fit decreasing. Dual feasible functions
    bound the sequences a part needs: a part that needs no more is done. Parts
    with a gap keep their nearly full sequences and give the documents of the
    others to new parts, mixed from all of them, which are packed again, for at
    most ``rounds`` rounds; in the last, everything stays.

    Returns one row per piece: ``_id, piece, start, length, ids_crc32,
    sequence_id, offset``, and ``ids`` (array) if asked for; no text is
    shuffled. NULL and empty texts are id 0 only. Repeated rows and ids, also
    NULL ones, are documents of their own. An empty table gives an empty
    result. Other columns are ignored. The file at ``tokenizer`` must be
    readable at the same path by all executors.
    """
    pieces = token_pieces(df, tokenizer, capacity, id_col, text_col, with_ids)
    items = pieces.where(F.col("length") < capacity).select(F.col("_row").alias("row"), "length")
    done = None
    for turn in range(rounds):
        count = items.count()
        if count == 0:
            break
        parts = -(-count // ITEMS_PER_PART)
        packed = _packed(items, parts, turn, capacity)
        last = turn == rounds - 1
        kept = packed if last else packed.where("closed")
        kept = kept.select(
            F.col("row").alias("_placed"),
            # A number per round, part and sequence in the part.
            (F.lit(turn).cast("long") * (1 << 57) + F.col("part") * (1 << 24) + F.col("bin")).alias("sequence_id"),
            "offset",
        )
        done = kept if done is None else done.unionByName(kept)
        items = packed.where("not closed").select("row", "length")
    whole = pieces.where(F.col("length") == capacity)
    whole = whole.withColumn("sequence_id", -1 - F.col("_row")).withColumn("offset", F.lit(0).cast("long"))
    if done is not None:
        rest = pieces.where(F.col("length") < capacity).join(done, F.col("_row") == F.col("_placed"))
        whole = whole.unionByName(rest.drop("_placed"))
    return whole.drop("_row")
