"""Hard negatives, fill-in-the-middle and SetSketch near copies against plain computations."""

import hashlib
import os
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from proseledger.llm import fill_middle, hard_negatives, ngram_join, places, set_sketch
from proseledger.llm.ngram_join import Sets
from proseledger.sources import shared

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, _id string, n long, form string, output string, restored string, fp long"
LONG = " ".join(f"word{i % 977}" for i in range(6000))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def table_of(spark, texts, parts=3):
    return spark.createDataFrame([(i, t, "clash", 7, "x", "y", "z", 1) for i, t in texts], SCHEMA).repartition(parts)


# --- near copies ----------------------------------------------------------------------------


def plain_components(texts, size, percent):
    """Set size and smallest reachable id per text, by comparing all with all."""
    sets = []
    for _, t in texts:
        words = WORD.findall(lower(t))
        grams = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    reach = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and reach[i] != reach[j]:
                old = reach[i]
                reach = [reach[j] if r == old else r for r in reach]
    least = {}
    for (i, _), r in zip(texts, reach):
        if r not in least or (i is not None and (least[r] is None or i < least[r])):
            least[r] = i
    return Counter((i, len(s), least[r] if s else i) for (i, _), s, r in zip(texts, sets, reach))


def near_copies(seed, groups, size):
    """Groups of near copies, some of them chains whose ends are not alike, some with a third of all rows."""
    pick = random.Random(seed)
    texts = []
    for _ in range(groups):
        words = [f"w{pick.randrange(400)}" for _ in range(pick.randrange(2, 80))]
        for _ in range(pick.choice([1, 2, size])):
            for _ in range(pick.randrange(0, 5)):
                words = list(words)
                words[pick.randrange(len(words))] = f"x{pick.randrange(10**6)}"
            texts.append(" ".join(words).swapcase() if pick.random() < 0.5 else "\n".join(words))
    pick.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_against_all_pairs(spark, seed, monkeypatch):
    if seed == 2:  # every path that only large inputs take
        monkeypatch.setattr(set_sketch, "BLOCK_ROWS", 5)
        monkeypatch.setattr(set_sketch, "PAIR_ROWS", 3)
    texts = near_copies(seed, 25, 40)
    texts += [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "ONE"), (905, "one two"), (None, "a b"),
              (5, texts[5][1]), (906, LONG), (907, LONG + " more"), (908, texts[3][1]), (None, "lone words here")]
    got = set_sketch.near_duplicates(table_of(spark, texts)).collect()
    assert Counter((r._id, r.n_shingles, r.component_id) for r in got) == plain_components(texts, 2, 80)


def test_near_copies_of_nothing(spark):
    assert set_sketch.near_duplicates(table_of(spark, [(1, "a b c")]).limit(0)).count() == 0
    got = set_sketch.near_duplicates(table_of(spark, [(1, None), (2, " ")])).collect()
    assert sorted((r._id, r.n_shingles, r.component_id) for r in got) == [(1, 0, 1), (2, 0, 2)]


def test_other_sizes_and_similarities(spark):
    texts = near_copies(7, 12, 10)
    got = set_sketch.near_duplicates(table_of(spark, texts), size=3, percent=70).collect()
    assert Counter((r._id, r.n_shingles, r.component_id) for r in got) == plain_components(texts, 3, 70)


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_of_large_groups_against_all_pairs(spark, seed, monkeypatch):
    """One group of near copies on half of all rows, many of them not alike themselves."""
    if seed == 2:
        monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 5)
        monkeypatch.setattr(places, "BLOCK_TOKENS", 300)
    pick = random.Random(seed)
    base = [f"b{pick.randrange(300)}" for _ in range(90)]
    texts = near_copies(seed + 10, 10, 12)
    for i in range(140):
        words = list(base)
        for _ in range(pick.randrange(0, 5)):
            words[pick.randrange(90)] = f"y{pick.randrange(10**6)}"
        texts.append((200 + i, " ".join(words[pick.randrange(0, 6):])))
    texts += [(5, texts[5][1]), (906, LONG), (907, LONG + " more"), (908, None), (909, "")]
    got = ngram_join.near_duplicates(table_of(spark, texts)).collect()
    assert Counter((r._id, r.n_shingles, r.component_id) for r in got) == plain_components(texts, 5, 75)


def test_the_stage_keeps_one_of_each_group(spark, tmp_path):
    texts = [(i, t) for i, t in near_copies(31, 15, 10)] + [(900, "so few"), (901, "SO few"), (902, "other words here")]
    rows = [(i, t, "en", "s", len(t)) for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for (i, _, least) in plain_components(texts, 5, 75) if i == least)
    assert {tuple(r) for r in kept} <= set(rows)


def test_signatures_never_hide_shared_tokens():
    rng = np.random.default_rng(1)
    for _ in range(200):
        pool = rng.integers(0, 2**64, 300, dtype=np.uint64)
        a, b = pool[:rng.integers(20, 120)], pool[rng.integers(0, 60):][:rng.integers(20, 120)]
        shared = len(np.intersect1d(a, b))
        size = ngram_join.signature_bytes(len(a))
        x, y = (np.frombuffer(ngram_join.signature(t, size), np.uint8) for t in (a, b))
        lost = min(len(t) - int(np.bitwise_count(s).sum(dtype=np.int64)) for t, s in ((a, x), (b, y)))
        common = int(np.bitwise_count(x & y).sum(dtype=np.int64))
        assert common + lost >= shared
        folded = x[:size // 2] | x[size // 2:], y[:size // 2] | y[size // 2:]
        assert (np.frombuffer(ngram_join.signature(a, size // 2), np.uint8) == folded[0]).all()


def test_likely_pairs_hold_every_similar_pair():
    """By their signatures, also where the widths differ; most of the others go before any set is fetched."""
    rng = np.random.default_rng(2)
    rows, similar = [], []
    for at in range(400):
        pool = rng.integers(0, 2**64, 400, dtype=np.uint64)
        a, b = (pool[begin:begin + rng.integers(100, 250)] for begin in (0, rng.integers(0, 60)))
        (bits_a, bits_b), (lost_a, lost_b) = ngram_join._signed([a, b])
        rows.append((at, 1000 + at, len(a), len(b), bits_a, bits_b, lost_a, lost_b))
        similar.append(100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b)))
    names = ["a", "b", "n_a", "n_b", "bits_a", "bits_b", "lost_a", "lost_b"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
    found = {r["a"] for out in ngram_join._likely_pairs(75)([batch]) for r in out.to_pylist()}
    assert {at for at, x in enumerate(similar) if x} <= found
    assert 20 < sum(similar) <= len(found) < 250


def shuffles_left(spark, work):
    """Shuffle files that are there after some work and were not before, once Spark has had time to remove them."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    there = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+\.data", files.getAllFiles().mkString(" ")))
    before = there()
    work()
    for _ in range(50):
        if not there() - before:
            break
        time.sleep(0.2)
    return there() - before


def test_near_copies_leave_no_shuffle_and_no_sets_behind(spark):
    """While a step runs, the disk holds its own shuffles and not those of all steps before."""
    docs = table_of(spark, near_copies(41, 12, 10))
    folder = f"{shared.shared_folder(spark)}/proseledger/{spark.sparkContext.applicationId}"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    assert not shuffles_left(spark, lambda: ngram_join.near_duplicates(docs))
    names = set(os.listdir(folder)) - before
    assert names and not [n for n in names if n.startswith(("whole_sets", "prefixes"))]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")


def test_the_stage_leaves_no_shuffle_behind(spark, tmp_path):
    texts = near_copies(41, 12, 10)
    rows = [(i, t, "en", "s", len(t)) for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert not shuffles_left(spark, lambda: corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)))


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**64, 300, dtype=np.uint64)
    made = set_sketch.registers(Sets(np.concatenate([a, a[:100], a[50:]]), np.array([0, 300, 400, 650])))
    assert (set_sketch.merged(made[1], made[2]) == made[0]).all()
    errors = []
    for _ in range(40):
        pool = rng.integers(0, 2**64, 500, dtype=np.uint64)  # 400 and 400 elements, 300 in common
        x, y = set_sketch.registers(Sets(np.concatenate([pool[:400], pool[100:]]), np.array([0, 400, 800])))
        n = np.array([400.0])
        greater, less = np.array([(x > y).sum()]), np.array([(x < y).sum()])
        errors.append(set_sketch.likeliest(n, n, greater, less)[0] - 0.6)
        assert not set_sketch.may_reach(0.95, n, n, greater, less)[0]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


# --- fill in the middle ----------------------------------------------------------------------


def plain_fill(i, text, seed=7, percent=100, spm_percent=50):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return i, n, "plain", None, None, text
    if h[3] % 100 < spm_percent:
        return i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("percent", [100, 60])
def test_fill_in_middle_and_back(spark, monkeypatch, percent):
    monkeypatch.setattr(fill_middle, "WINDOW", 61)
    pick = random.Random(4)
    pool = ["a", "é", "😀", "\n", "\n", "\r\n", "<", "<P", "S>", "M>", "a line of text\n", " ", " "]
    texts = [(i, "".join(pick.choice(pool) for _ in range(pick.randrange(40)))) for i in range(400)]
    texts += [(400, None), (401, ""), (402, "\n"), (403, "x<S>y\nz"), (None, "a\nb\nc"), (5, "a\nb"), (5, "a\nb"),
              (404, "line of a very long text\n" * 20_000), (405, "x" * 300_000), (406, "\n" * 5000)]
    df = table_of(spark, texts)
    made = fill_middle.fill_in_middle(df, percent=percent)
    columns = ["_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert Counter(tuple(r) for r in made.select(columns).collect()) == Counter(
        plain_fill(i, t, percent=percent) for i, t in texts)
    back = fill_middle.restore(made.withColumn("restored", F.lit("clash"))).collect()
    assert Counter((r._id, r.restored) for r in back) == Counter((i, t or "") for i, t in texts)
    assert fill_middle.restore(fill_middle.fill_in_middle(df.limit(0))).count() == 0


def test_marks_that_could_arise_by_chance_are_refused(spark):
    df = table_of(spark, [(1, "a\nb")])
    for marks in (("<P", "<PS", "<M"), ("", "<S>", "<M>"), ("ab", "ca", "d")):
        with pytest.raises(ValueError):
            fill_middle.fill_in_middle(df, marks=fill_middle.Marks(*marks))
    marks = fill_middle.Marks("<|prefix|>", "<|suffix|>", "<|middle|>")
    row = fill_middle.restore(fill_middle.fill_in_middle(df, marks=marks), marks).first()
    assert row.restored == "a\nb" and "<|middle|>" in row.output


# --- hard negatives --------------------------------------------------------------------------


def plain_negatives(rows, is_anchor, positives=5, negatives=10):
    """All rows against all, in whole numbers."""
    used = [(i, lab, [int(np.floor(256 * float(x))) for x in v]) for i, v, lab in rows
            if i is not None and lab is not None and v is not None
            and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for i, lab, v in used:
        if not is_anchor(i):
            continue
        scored = [(-dot(v, w), j, other) for j, other, w in used if j != i]
        same = sorted((s, j) for s, j, other in scored if other == lab)[:positives]
        for s, j in same:
            window = sorted((t, k) for t, k, other in scored if other != lab and 30 * -s <= 100 * -t <= 90 * -s)
            out |= {(i, j, rank, k, -s, -t) for rank, (t, k) in enumerate(window[:negatives], 1)}
    return out


def vectors_of(seed, count, width):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(6, width))
    rows = []
    for i in range(count):
        v = middles[i % 6] + rng.normal(size=width) * rng.choice([0.05, 0.5])
        rows.append((i, (v / np.linalg.norm(v)).tolist(), int(rng.integers(0, 4))))
    return rows


EMBEDDINGS = "vec_id long, embedding array<float>, label int, id string, score int, cell string"


def embeddings(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], EMBEDDINGS).repartition(3)


def found_in(df, **settings):
    got = hard_negatives.mine_hard_negatives(df, F.col("vec_id") % 10 == 0, **settings).collect()
    assert len(got) == len(set(got))
    return {(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got}


@pytest.mark.parametrize("width", [8, 7])
def test_hard_negatives_against_all_pairs(spark, monkeypatch, width):
    # Many cells, small blocks and several rounds.
    monkeypatch.setattr(hard_negatives, "FIRST_ROWS", 20)
    monkeypatch.setattr(hard_negatives, "GROWTH", 3)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 40)
    monkeypatch.setattr(hard_negatives, "BLOCK_VISITORS", 7)
    rows = vectors_of(width, 240, width)
    rows = [(i, np.float32(v).tolist(), lab) for i, v, lab in rows]
    rows += [(300 + i, rows[1][1], i % 3) for i in range(80)]  # one vector on a quarter of the rows
    rows += [(500, None, 1), (510, [None] * width, 1), (520, [float("nan")] * width, 1), (530, rows[0][1], None),
             (540, [float("inf")] + [0.0] * (width - 1), 2), (550, [0.0] * width, 2), (None, rows[0][1], 1),
             (560, [-x for x in rows[0][1]], 0), (570, [0.25] * (width - 2), 3), (580, [], 1)]
    expected = plain_negatives([(i, v and (v + [0.0] * (width - len(v))), lab) if i != 580 else (i, [0.0] * width, lab)
                                for i, v, lab in rows], lambda i: i % 10 == 0)
    assert found_in(embeddings(spark, rows), codewords=5) == expected and len(expected) > 500


def test_hard_negatives_of_few_rows(spark):
    df = embeddings(spark, [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.5], 2)])
    assert found_in(df) == {(0, 1, 1, 2, 65536, 32768)}
    assert found_in(df.where("vec_id < 2")) == set()
    assert found_in(df.limit(0)) == set()
    assert found_in(embeddings(spark, [(0, None, 1)])) == set()
    again = df.unionByName(df.where("vec_id = 0"))  # an anchor twice counts once
    assert found_in(again) == {(0, 1, 1, 2, 65536, 32768)}


def test_cells_come_in_order_and_bound_their_rows():
    rng = np.random.default_rng(3)
    one, two = rng.normal(size=7), rng.normal(size=9)
    order = list(hard_negatives.cells_by_bound(one, two))
    assert sorted((i, j) for _, i, j in order) == [(i, j) for i in range(7) for j in range(9)]
    assert [b for b, _, _ in order] == sorted((one[i] + two[j] for i in range(7) for j in range(9)), reverse=True)
    points = rng.integers(-300, 300, (500, 6))
    words = hard_negatives.fit(points[:, :3].astype(float), 8), hard_negatives.fit(points[:, 3:].astype(float), 8)
    (c1, f1), (c2, f2) = hard_negatives.nearest(points[:, :3], words[0]), hard_negatives.nearest(points[:, 3:], words[1])
    radii = tuple(np.array([f[c == k].max(initial=0) for k in range(8)]) for c, f in ((c1, f1), (c2, f2)))
    books = hard_negatives.Codebooks(words, radii, np.ones((8, 8), np.int64), 6)
    for anchor in points[:50].astype(float):
        (low1, high1), (low2, high2) = hard_negatives.half_bounds(books, anchor)
        scores = points @ anchor
        assert (low1[c1] + low2[c2] <= scores).all() and (scores <= high1[c1] + high2[c2]).all()


def test_products_of_large_numbers_are_exact():
    a, b = np.array([[2**30, -(2**30) + 1]]), np.array([[2**30 - 1, 2**30 - 3]])
    assert hard_negatives.products(a, b)[0, 0] == 2**30 * (2**30 - 1) + (1 - 2**30) * (2**30 - 3)
