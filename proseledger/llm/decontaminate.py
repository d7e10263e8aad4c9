"""Test items found in training texts: BM25 over an index of the items, block-max WAND, verification."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Sequence
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, as_bytes, map_batches, slices, small_side, store

K1, B = 1.2, 0.75
# Postings per block.
BLOCK = 16
# Items per column of the table of bounds, which many passages are held against at once.
BOUND_ITEMS = 4
# Items of one index; more items make more indexes.
ITEMS_PER_INDEX = 1024
# Indexes are broadcast together up to about so many bytes, and the texts are read once for all of these.
PASS_BYTES = 128 << 20
# Passages overlap by half; no item is longer than half a passage.
SHORTEST_STEP = 64

_FOLD = bytearray(ASCII_LOWER)
for _code in range(128):
    if not chr(_code).isalnum():
        _FOLD[_code] = 32
_FOLD = bytes(_FOLD)


def terms_of(text: bytes) -> list[bytes]:
    """Words in lower case (A-Z), without ASCII punctuation."""
    return text.translate(_FOLD).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The words of an item's question and answer.

    The answer follows the last question mark; without one it is the last
    sentence; of a single sentence it is the last third.
    """
    marks = [m.end() for m in re.finditer(r"\?", text)]
    ends = [m.end() for m in re.finditer(r"[.!?](?:\s|$)|\n", text)]
    for cut in [*marks[-1:], *reversed(ends)]:
        question, answer = terms_of(text[:cut].encode()), terms_of(text[cut:].encode())
        if question and answer:
            return question, answer
    words = terms_of(text.encode())
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


def _grams(words: Sequence[bytes], n: int) -> set:
    """Each ``n`` words in a row; fewer words have none."""
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


class Index(NamedTuple):
    """Inverted index of items; contributions are shares of an item's score for itself."""

    terms: dict[bytes, int]
    # Per term: items, contributions, last item and greatest contribution of each block.
    postings: list[tuple[list[int], list[float], list[int], list[float]]]
    greatest: np.ndarray
    # Per term and block of ``BOUND_ITEMS`` items: the greatest contribution.
    bounds: np.ndarray
    # Per item: id, words of question and answer.
    items: list[tuple]
    step: int


def build_index(items: list[tuple], frequencies: dict[bytes, int], n_items: int, mean: float, step: int):
    """Index (id, text) rows; the term statistics are those of all items."""
    terms: dict[bytes, int] = {}
    found: list[list[tuple[int, float]]] = []
    kept = []
    for at, (item, text) in enumerate(items):
        words = terms_of((text or "").encode())
        counts: dict[bytes, int] = {}
        for word in words:
            counts[word] = counts.get(word, 0) + 1
        norm = K1 * (1 - B + B * len(words) / mean)
        weights = {
            word: np.log(1 + (n_items - frequencies[word] + 0.5) / (frequencies[word] + 0.5))
            * tf * (K1 + 1) / (tf + norm)
            for word, tf in counts.items()
        }
        total = sum(weights.values())
        for word, weight in weights.items():
            number = terms.setdefault(word, len(terms))
            if number == len(found):
                found.append([])
            found[number].append((at, float(weight / total)))
        kept.append((item, *question_and_answer(text or "")))
    postings = []
    for entries in found:
        ids, weights = [i for i, _ in entries], [w for _, w in entries]
        starts = range(0, len(ids), BLOCK)
        postings.append((
            ids, weights,
            [ids[min(s + BLOCK, len(ids)) - 1] for s in starts],
            [max(weights[s:s + BLOCK]) for s in starts],
        ))
    greatest = np.array([max(w) for _, w, _, _ in postings]) if postings else np.zeros(0)
    bounds = np.zeros((len(found), -(-len(items) // BOUND_ITEMS)), np.float32)
    for number, entries in enumerate(found):
        for item, weight in entries:
            block = item // BOUND_ITEMS
            bounds[number, block] = max(bounds[number, block], weight)
    return Index(terms, postings, greatest, bounds, kept, step)


def block_max_wand(index: Index, terms: Sequence[int], threshold: float) -> list[tuple[int, float]]:
    """All items whose score for the terms reaches the threshold.

    Lists stand in the order of their current items. The pivot is the first item
    that the greatest contributions of the lists up to it could lift over the
    threshold; everything before is skipped. If the greatest contributions of
    the pivot's blocks can't, all lists move behind the nearest end of a block.
    """
    # Sums of shares in any order differ in the last digits.
    threshold -= 1e-9
    cursors = [[index.postings[t][0][0], t, 0] for t in terms]
    found = []
    while cursors:
        cursors.sort()
        bound, pivot = 0.0, -1
        for at, (_, term, _) in enumerate(cursors):
            bound += index.greatest[term]
            if bound >= threshold:
                pivot = at
                break
        if pivot < 0:
            return found
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        bound, nearest = 0.0, None
        for _, term, _ in cursors[:pivot + 1]:
            _, _, lasts, maxima = index.postings[term]
            block = bisect_left(lasts, item)
            if block < len(lasts):
                bound += maxima[block]
                nearest = lasts[block] if nearest is None else min(nearest, lasts[block])
        if bound >= threshold:
            target = item
            if cursors[0][0] == item:
                score = sum(index.postings[t][1][at] for _, t, at in cursors[:pivot + 1])
                if score >= threshold:
                    found.append((item, score))
                target = item + 1
        else:
            # The pivot's blocks end at nearest; the next list may start before that.
            target = item + 1 if nearest is None else nearest + 1
            if pivot + 1 < len(cursors):
                target = min(target, cursors[pivot + 1][0])
            target = max(target, item + 1)
        moved = []
        for cursor in cursors[:pivot + 1]:
            ids = index.postings[cursor[1]][0]
            if cursor[0] < target:
                cursor[2] = bisect_left(ids, target, cursor[2])
                if cursor[2] == len(ids):
                    continue
                cursor[0] = ids[cursor[2]]
            moved.append(cursor)
        cursors = moved + cursors[pivot + 1:]
    return found


def possible_passages(index: Index, passage: np.ndarray, term: np.ndarray, threshold: float) -> np.ndarray:
    """Passages in which the greatest contributions of some block of items reach the threshold.

    The test that lets block-max WAND skip a block, for many passages and all blocks at once.
    """
    cuts = np.flatnonzero(np.diff(passage, prepend=-1))
    out = []
    for at in range(0, len(cuts), 4096):
        begin = cuts[at]
        end = cuts[at + 4096] if at + 4096 < len(cuts) else len(passage)
        some = cuts[at:at + 4096]
        sums = np.add.reduceat(index.bounds[term[begin:end]], some - begin)
        # Single precision: a little below.
        out.append(passage[some[sums.max(axis=1) >= threshold - 1e-4]])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def leaks_in(index: Index, texts: list[bytes], threshold: float, min_question: float, min_answer: float):
    """Verified (text, item, score, question overlap, answer overlap), the best passage of each pair."""
    words = [terms_of(t) for t in texts]
    lookup = index.terms.get
    numbers = np.fromiter((lookup(w, -1) for ws in words for w in ws), np.int64, sum(map(len, words)))
    lengths = np.array([len(ws) for ws in words])
    segments = np.maximum(1, -(-lengths // index.step))
    passages = np.maximum(1, segments - 1)
    first = np.cumsum(passages) - passages
    text = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(numbers)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    hit = numbers >= 0
    text, segment, term = text[hit], place[hit] // index.step, numbers[hit]
    # A segment belongs to the passage that starts with it and to the one that ends with it.
    starts, ends = segment < passages[text], segment > 0
    passage = np.concatenate([(first[text] + segment)[starts], (first[text] + segment - 1)[ends]])
    width = max(1, len(index.postings))
    pairs = np.unique(passage * width + np.concatenate([term[starts], term[ends]]))
    passage, term = pairs // width, pairs % width
    best: dict[tuple[int, int], tuple] = {}
    for p in possible_passages(index, passage, term, threshold).tolist():
        begin, end = np.searchsorted(passage, [p, p + 1])
        found = block_max_wand(index, term[begin:end].tolist(), threshold)
        if not found:
            continue
        t = int(np.searchsorted(first, p, "right")) - 1
        at = (p - int(first[t])) * index.step
        own = words[t][at:at + 2 * index.step]
        grams, bag = {n: _grams(own, n) for n in (1, 2, 3)}, set(own)
        for item, score in found:
            _, question, answer = index.items[item]
            # A question of one or two words is one gram of its own length.
            n = min(3, len(question))
            asked, given = _grams(question, n) if n else set(), set(answer)
            q = len(asked & grams[n]) / len(asked) if asked else 1.0
            a = len(given & bag) / len(given) if given else 1.0
            if q >= min_question and a >= min_answer:
                best[t, item] = max(best.get((t, item), (0.0, 0.0, 0.0)), (q + a, score, q))
    return [(t, item, score, q, total - q) for (t, item), (total, score, q) in best.items()]


def _indexes(items: DataFrame):
    """The items in indexes of bounded size, by length class; statistics are of all items."""

    def rows(batches):
        for batch in batches:
            words = [terms_of(t) for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("text"),
                 pa.array([len(w) for w in words], pa.int64()),
                 pa.array([sorted(set(w)) for w in words], pa.list_(pa.binary()))],
                ["item", "text", "n", "terms"],
            )

    item_type = dict(items.dtypes)["item"]
    made = store(
        map_batches(items, rows, f"item {item_type}, text string, n long, terms array<binary>")
        .where("n > 0"), "items",
    )
    total, words = made.agg(F.count("*"), F.sum("n")).first()
    if total == 0:
        return
    made = made.withColumn(
        "step", F.greatest(F.lit(SHORTEST_STEP), F.pow(2, F.ceil(F.log2("n"))).cast("long"))
    )
    frequencies = store(
        made.select(F.explode("terms").alias("term")).groupBy("term").count(), "frequencies"
    )
    for step, count in made.groupBy("step").count().orderBy("step").collect():
        parts = -(-count // ITEMS_PER_INDEX)
        for part in range(parts):
            of = (F.col("step") == step) & (
                F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part
            )
            some = made.where(of)
            terms = some.select(F.explode("terms").alias("term")).distinct()
            known = {bytes(t): c for t, c in frequencies.join(terms, "term").collect()}
            listed = [(r.item, r.text) for r in some.select("item", "text").orderBy("item", "text").collect()]
            if listed:
                yield build_index(listed, known, total, words / total, step)


def _passes(indexes):
    """Indexes that share a pass over the texts: as many as ``PASS_BYTES`` allow, or a single larger one."""
    together, size = [], 0
    for index in indexes:
        postings = sum(len(items) for items, _, _, _ in index.postings)
        # A posting is two numbers in Python lists; items keep their words.
        own = index.bounds.nbytes + 200 * postings
        if together and size + own > PASS_BYTES:
            yield together
            together, size = [], 0
        together.append(index)
        size += own
    if together:
        yield together


def find_leaks(
    df: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.6,
    min_question: float = 0.5,
    min_answer: float = 0.6,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Documents that hold items of a benchmark: one row per document and item.

    Every text is cut into passages that overlap by half and are at least twice
    as long as an item; every passage is a query. An item's BM25 score is a
    share of its score for itself; all items from ``threshold`` on are retrieved
    (by block-max WAND, nothing is cut off) and verified: at least
    ``min_question`` of the question's word trigrams and ``min_answer`` of the
    answer's words must be in the passage. A question of one or two words must
    be in it as it is.

    Returns ``_id, _key`` (hash of the text), ``item, score, question_overlap,
    answer_overlap`` of the best passage. NULL and empty texts and items without
    a word find nothing; a NULL id is kept as it is; repeated rows are reported
    each. An index holds at most ``ITEMS_PER_INDEX`` items; indexes of about
    ``PASS_BYTES`` together are broadcast at a time, and only items beyond that
    make another pass over the texts.
    """
    base = df.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")
    ).withColumn("_key", F.xxhash64("_text"))
    items = benchmark.select(
        F.col(item_col).alias("item"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text")
    )
    types = dict(base.dtypes) | dict(items.dtypes)
    schema = (f"_id {types['_id']}, _key long, item {types['item']}, score double, "
              "question_overlap double, answer_overlap double")
    item_type = items.schema["item"].dataType
    found = None
    for indexes in _passes(_indexes(items)):
        shared = df.sparkSession.sparkContext.broadcast(indexes)
        part = map_batches(base, _leak_rows(shared, threshold, min_question, min_answer, item_type), schema)
        found = part if found is None else found.unionByName(part)
    return df.sparkSession.createDataFrame([], schema) if found is None else found


def _leak_rows(shared, threshold, min_question, min_answer, item_type):
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(item_type)

    def rows(batches):
        for batch in batches:
            texts = as_bytes(batch.column("_text"))
            for (begin, end), index in product(slices(texts), shared.value):
                found = leaks_in(index, texts[begin:end], threshold, min_question, min_answer)
                if not found:
                    continue
                at = pa.array([begin + f[0] for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").take(at), batch.column("_key").take(at),
                     pa.array([index.items[f[1]][0] for f in found], kind),
                     *[pa.array([f[i] for f in found], pa.float64()) for i in (2, 3, 4)]],
                    ["_id", "_key", "item", "score", "question_overlap", "answer_overlap"],
                )

    return rows


def drop_leaked(df: DataFrame, leaks: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of documents without a leak, all columns."""
    leaked = small_side(store(leaks.select("_id", "_key").distinct(), "leaked"))
    key = F.xxhash64(F.coalesce(df[text_col].cast("string"), F.lit("")))
    same = df[id_col].eqNullSafe(leaked["_id"]) & (key == leaked["_key"])
    return df.join(leaked, same, "left_anti")
