"""Each operator against a plain computation on small rows with all the awkward cases."""

import hashlib
import math
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from proseledger.llm import (
    decontaminate, licenses, line_dedup, lm_score, ngram_join, packing, pii, quality, queries, sharding,
    suffix_dedup,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id long, _text string"
LONG = " ".join(f"word{i % 977}" for i in range(6000))
BASE = " ".join(f"alpha{i}" for i in range(60))
TEXTS = [
    (1, BASE), (2, BASE + " beta"), (2, BASE + " beta"), (3, None), (4, ""), (5, " \n\t "),
    (6, LONG), (7, LONG), (None, "x y"), (8, "one two"), (9, "ONE two"),
    (10, "mail a.b@c.de or +44 20 7946 0958\ncard 4111 1111 1111 1111, host 10.0.0.1 and 300.1.1.1"),
    (11, "Licensed under the Apache License, Version 2.0.\n" + "la " * 80),
    (12, "first line with quite a few words in it\nsecond line with quite a few words in it\nend"),
    (13, "other\nfirst line with quite a few words in it\nsecond line with quite a few words in it"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i else None, "s", 0, -1, "clash") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_near_duplicates(docs, empty):
    got = {(r._id, r.n_shingles): r.component_id for r in ngram_join.near_duplicates(docs).collect()}
    assert got[(1, 56)] == got[(2, 57)] == 1
    assert got[(6, len(set(zip(*[LONG.split()[i:] for i in range(5)]))))] == 6
    assert got[(9, 1)] == 8 and got[(3, 0)] == 3 and got[(4, 0)] == 4 and got[(5, 0)] == 5
    assert got[(None, 1)] is None
    kept = ngram_join.drop_near_duplicates(docs).collect()
    assert Counter(r.doc_id for r in kept)[2] == 0 and Counter(r.doc_id for r in kept)[1] == 1
    assert kept[0].asDict().keys() == docs.first().asDict().keys()
    assert ngram_join.near_duplicates(empty).count() == 0


def test_packing(docs, empty):
    rows = packing.pack_documents(docs, TOKENIZER, 64, with_ids=True).collect()
    assert len({(r._id, r.piece) for r in rows}) <= len(rows)
    by = {}
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    bound = packing.lower_bound(np.bincount([r.length for r in rows], minlength=65), 64)
    assert bound <= len(by) <= bound + 1
    assert [r.length for r in rows if r._id == 4] == [1]
    assert packing.pack_documents(empty, TOKENIZER).count() == 0


def test_encode_is_the_tokenizers():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(TOKENIZER)
    plain.encode_special_tokens = True
    rng = np.random.default_rng(1)
    pool = [chr(i) for i in range(0x234)] + [" ", "\n", "'s", "word", "<|endoftext|>", "中", " ", "٣"]
    texts = ["".join(rng.choice(pool, rng.integers(0, 40))) for _ in range(3000)]
    expected = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert [e.tolist() for e in packing.encode(texts, TOKENIZER)] == expected


def test_long_white_space_and_runs_are_encoded():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(TOKENIZER)
    plain.encode_special_tokens = True
    texts = ["a" + " " * 2_000_000 + "b", "\n" * 60_000, " " * 50_000 + "x", "\t " * 40_000, "a" * 200_000, "!" * 200_000,
             "1" * 200_000, "a\u2003" * 100]
    for text, got in zip(texts, packing.encode(texts, TOKENIZER)):
        assert got.tolist() == plain.encode(text, add_special_tokens=False).ids


def test_other_tokenizer_files():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    texts = ["It's a plain text of 3 lines\nand words", "", "  x"]
    assert [e.tolist() for e in packing.encode(texts, path)] == [
        plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_long_text_of_signals(spark):
    rng = np.random.default_rng(4)
    words = rng.choice(["license", "software", "public", "copyright", "permission", "the", "of", "and"], 100_000)
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    body = next(b for n, b in licenses.TEMPLATES if n == "MIT" and len(b) > 100)
    text = " ".join(words[:50_000]) + " " + body + " " + " ".join(words[50_000:])
    rows = spark.createDataFrame([("a/b.txt", text), ("c.txt", notice[:20])], "path string, text string")
    got = {r.path: r.licence for r in licenses.scan_licenses(rows).collect()}
    assert got == {"a/b.txt": "MIT", "c.txt": None}


def cosine_of(a, b, idf):
    weights = [Counter({w: n * idf(w) for w, n in Counter(t).items()}) for t in (a, b)]
    dot = sum(weights[0][w] * weights[1][w] for w in weights[0])
    return dot / math.prod(math.sqrt(sum(v * v for v in w.values())) for w in weights)


def test_cosines_of_lines_recomputed(spark):
    """One-line texts: the documents of the TF-IDF are these lines and the templates."""
    lines = ["Licensed under the MIT licence by me", "Released under the Apache License", "public software of the town",
             "This work is licensed under a Creative Commons Attribution 4.0 License", "permission denied"]
    words = lambda t: [w for w in (x.strip(".-") for x in re.split(r"[^a-z0-9.\-]+", t.lower())) if w]
    documents = [words(t) for t in lines] + [words(b) for _, b in licenses.TEMPLATES]
    counts = Counter(w for d in documents for w in set(d))
    idf = lambda w: math.log(len(documents) / max(counts[w], 1)) + 1
    rows = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(lines)], "path string, text string")
    got = {r.path: r for r in licenses.scan_licenses(rows, min_cosine=0.3).collect()}
    for i, t in enumerate(lines):
        own = words(t)
        templates = [words(body) for _, body in licenses.TEMPLATES]
        passages = [own]
        for template in templates:
            for at, w in enumerate(template):
                for j, v in enumerate(own):
                    same = v == w or (v, w) in (("licence", "license"), ("licenced", "licensed"))
                    if w in licenses.SIGNALS and same:
                        passages.append(own[max(j - at, 0):max(j - at + len(template), 0)])
        best = max(cosine_of(p, template, idf) for p in passages if p for template in templates)
        if best >= 0.3:
            assert got[f"f{i}"].cosine == pytest.approx(best), (t, got[f"f{i}"])
        else:
            assert got[f"f{i}"].licence is None


def test_licenses(spark, docs, empty):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/x.py", None), ("a/b/x.py", None),
            ("a/b/COPYING.txt", "Licensed under CC BY-NC 4.0."), ("z", ""), (None, "x"),
            ("a/y", "foo\nLicensed under the Apache License, Version 2.0\n" + LONG)]
    got = {r.path: (r.licence, r.origin) for r in licenses.scan_licenses(
        spark.createDataFrame([(*r, 1, "k") for r in rows], "path string, text string, licence int, _key string")
    ).collect()}
    assert got == {"a/LICENSE": ("MIT", "own"), "a/b/x.py": ("CC-BY-NC-4.0", "inherited"),
                   "a/b/COPYING.txt": ("CC-BY-NC-4.0", "own"), "z": (None, None), None: (None, None),
                   "a/y": ("Apache-2.0", "own")}
    assert licenses.scan_licenses(empty.withColumnRenamed("source", "path")).count() == 0


def test_license_query_inherits(spark, tmp_path):
    """Documents of a folder inherit from the one that has a licence; one that only speaks of licences gives none."""
    rows = [(1, "s", "en", "Some prose.\nReleased under the MIT License.\nMore."), (2, "s", "en", "Prose."),
            (3, "s", "en", None), (4, "s", "de", "Prosa."), (5, "t", "en", "He lost his driving license last week in town"),
            (6, "t", "en", "Prose."), (0, "s", "en", "I have no license for this boat, nor will I ever get one"),
            (7, None, None, "x"), (8, "s", "en", "Licensed under CC BY-NC 4.0.")]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.path, r.licence, r.origin) for r in queries.QUERIES["op3_license_scan"].run(spark, str(tmp_path)).collect()}
    assert got == {
        0: ("s/en/LICENSE-0", "MIT", "inherited"), 1: ("s/en/LICENSE-1", "MIT", "own"), 2: ("s/en/2", "MIT", "inherited"),
        3: ("s/en/3", "MIT", "inherited"), 4: ("s/de/4", None, None), 5: ("t/en/LICENSE-5", None, None),
        6: ("t/en/6", None, None), 7: ("7", None, None), 8: ("s/en/LICENSE-8", "CC-BY-NC-4.0", "own"),
    }


def test_wrapped_licenses(spark):
    notices = {name: max((b for n, b in licenses.TEMPLATES if n == name), key=len)
               for name in ("MIT", "BSD-3-Clause", "GPL-3.0")}
    wrapped = lambda t, mark: "\n".join(mark + x for x in textwrap.wrap(t, 60))
    code = "\n".join(f"value{i} = compute{i}(other{i})" for i in range(200))
    rows, expected = [], set()
    for name, notice in notices.items():
        rows += [(f"{name}/x/a.py", f"{wrapped('Copyright 2020 Some Body. ' + notice, '# ')}\n{code}"),
                 (f"{name}/LICENSE", f"Title\n\n{wrapped(notice, '')} and more\n{wrapped(code, '')}"),
                 (f"{name}/x/line.txt", f"{code.replace(chr(10), ' ')} {notice} {code.replace(chr(10), ' ')}"),
                 (f"{name}/x/b.py", code)]
        expected |= {(p, name, "own") for p in (f"{name}/x/a.py", f"{name}/LICENSE", f"{name}/x/line.txt")}
        expected |= {(f"{name}/x/b.py", name, "inherited")}
    got = licenses.scan_licenses(spark.createDataFrame(rows, "path string, text string")).collect()
    assert {(r.path, r.licence, r.origin) for r in got} == expected
    assert all(r.cosine == pytest.approx(1) for r in got)


def base_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m[0])
        total = sum(int(x) if i % 2 == 0 else 2 * int(x) - 9 * (int(x) > 4) for i, x in enumerate(d[::-1]))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"\D", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_personal_data(spark, docs, empty):
    rng = np.random.default_rng(3)
    pool = ["a", "@", ".", "1", "22", "+", "-", " ", "é", "b.c", "4111 1111 1111 1111", "x@y.z", "(",
            ")", "10.0.0.1", "😀", "256.1.1.1", "_", "GB82 WEST 1234 5698 7654 32"]
    texts = ["".join(rng.choice(pool, rng.integers(0, 60))) for _ in range(300)]
    texts += ["x@y.z " * 2000, "1" * 20000, "a" * 20000, None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in pii.find_personal_data(rows).collect():
        assert [(s.start, s.order, s.end) for s in r.pii_base] == base_spans(r.text or "")
    kinds = [s.kind for r in pii.find_personal_data(docs).where("doc_id = 10").collect() for s in r.pii_spans]
    assert kinds == ["email", "phone", "card", "ip"]
    iban = spark.createDataFrame([("account GB82 WEST 1234 5698 7654 32",), ("GB82 WEST 1234 5698 7654 33",)], "text string")
    assert sorted(len(r.pii_spans) for r in pii.find_personal_data(iban).collect()) == [0, 1]
    assert pii.find_personal_data(empty).count() == 0


def test_lines(docs, empty):
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert got[13].text == "other" and got[13].n_deleted == 2 and got[12].n_deleted == 0
    assert got[3].text is None and got[3].n_lines == 1 and got[4].text == "" and got[12]._text == "clash"
    assert line_dedup.dedup_lines(empty).count() == 0


def test_single_lines(spark, tmp_path):
    common = "one line of eight words that many share"
    texts = {1: f"a\n{common}\nb", 2: f"c\n  {common}\nd\n{common}", 3: common, 4: "few words\ne", 5: "few words\nf",
             6: f"{common}\nsecond line after it\ng", 7: f"h\n{common}\nsecond line after it", 8: None}
    rows = [(i, t, "en", "s", 0) for i, t in texts.items()]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    seen, expected = set(), {}
    for i, t in texts.items():
        left = []
        for line in (t or "").split("\n"):
            bare = line.strip()
            if not (len(bare.split()) >= 8 and bare in seen):
                left.append(line)
            seen.add(bare)
        expected[i] = t and "\n".join(left)
    expected[7] = "h"  # Two lines in a row that document 6 has.
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(table, single_words=8).collect()}
    assert got == expected
    kept = corpus_pipeline.line_dedup_stage(spark, table, str(tmp_path)).collect()
    assert {r.doc_id: r.text for r in kept} == {i: t for i, t in expected.items() if t}


def later_matches(texts, least):
    """Lines that a later match of two or more lines, ``least`` words together, covers; line by line."""
    lines = {i: [x.strip() for x in (t or "").split("\n") if x.strip()] for i, t in texts.items()}
    first, gone = {}, set()
    for i, own in sorted(lines.items()):
        for at in range(len(own) - 1):
            first.setdefault((own[at], own[at + 1]), (i, at))
    for i, own in lines.items():
        source = [first[own[at], own[at + 1]] for at in range(len(own) - 1)]
        at = 0
        while at < len(source):
            to = at + 1
            while to < len(source) and source[to] == (source[at][0], source[at][1] + to - at):
                to += 1
            begin = at if source[at][0] != i else max(at, source[at][1] + 2)
            if source[at] != (i, at) and sum(len(x.split()) for x in own[at:to + 1]) >= least:
                gone.update((i, x) for x in range(begin, to + 1))
            at = to
    return {i: "\n".join(x for at, x in enumerate(own) if (i, at) not in gone) for i, own in lines.items()}


def test_short_lines(spark):
    """Matches count by the words of all their lines, so menus go too; short runs alone stay."""
    rng = np.random.default_rng(5)
    menu = "\n".join(f"entry {i}" for i in range(20))
    texts = {1: f"intro one\n{menu}\nend one", 2: f"other start\n{menu}\nnothing", 3: "entry 3\nentry 4\nx",
             4: "", 5: f"{menu}\n{menu}"}
    for i in range(6, 120):
        texts[i] = "\n".join(rng.choice(["a", "b c", "d", "e f g", "h"], rng.integers(0, 14)))
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(rows).collect()}
    assert got == later_matches(texts, 8)
    assert got[2] == "other start\nnothing" and got[3] == texts[3] and got[5] == ""


def test_byte_strings(spark, docs, empty):
    rng = np.random.default_rng(2)
    parts = ["".join(rng.choice(list("ab"), rng.integers(5, 60))) for _ in range(25)] + ["é" * 30, "x" * 99]
    rows = [(i, "".join(rng.choice(parts, rng.integers(0, 6)))) for i in range(150)]
    rows += [(150, None), (151, "a" * 400), (5, "zz" * 30), (5, "zz" * 30)]
    length, count, expected = 24, Counter(), []
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[j:j + length] for j in range(len(b) - length + 1))
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for j in range(len(b) - length + 1):
            if count[b[j:j + length]] > 1:
                gone[j:j + length] = [True] * length
        runs = sum(g and (x == 0 or not gone[x - 1]) for x, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        expected.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r._id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup.remove_repeated(table, length, 8).collect()]
    assert sorted(got) == sorted(expected)
    assert suffix_dedup.remove_repeated(empty).count() == 0


def test_leaks(spark, docs, empty):
    item = "What is the tallest tower in this invented town? It is the old water tower."
    table = spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id long, text string")
    texts = [(1, LONG + " " + item + " " + LONG), (2, "the old town"), (3, None), (4, item), (4, item)]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    got = decontaminate.find_leaks(rows, table).collect()
    assert sorted((r._id, r.item) for r in got) == [(1, 7), (4, 7), (4, 7)]
    assert [r.doc_id for r in decontaminate.drop_leaked(rows, decontaminate.find_leaks(rows, table)).collect()] in ([2, 3], [3, 2])
    assert decontaminate.find_leaks(empty, table).count() == 0
    assert decontaminate.find_leaks(rows, table.where("false")).count() == 0


def test_leaks_with_a_short_question(spark):
    answer = "Seven grey herons stood on the jetty before the rain came over the lake."
    items = [(1, f"Herons. {answer}"), (2, f"Grey herons? {answer}"), (3, f"Who stood there? {answer}"),
             (4, "tower"), (5, "water tower")]
    texts = [(i, f"{LONG} {t} {LONG}") for i, t in items] + [(6, LONG), (7, "Herons"), (8, "tower of water")]
    joined = lambda t: f" {b' '.join(decontaminate.terms_of(t.encode())).decode()} "
    whole = {(i, k) for i, t in texts for k, item in items if joined(item) in joined(t)}
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    leaks = decontaminate.find_leaks(rows, table)
    got = {(r._id, r.item): r for r in leaks.collect()}
    assert whole >= {(i, i) for i, _ in items} and whole <= got.keys()
    assert all(got[pair].question_overlap == 1 for pair in whole)
    assert not {i for i, _ in got} & {6, 7}
    assert (8, 4) in got and (8, 5) not in got
    assert {r.doc_id for r in decontaminate.drop_leaked(rows, leaks).collect()} == {6, 7}


def test_block_max_wand():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words, rng.integers(1, 30)))) for i in range(200)]
    counts = Counter(w for _, t in items for w in set(decontaminate.terms_of(t.encode())))
    index = decontaminate.build_index(items, counts, 200, 15.0, 64)
    for _ in range(100):
        terms = sorted(rng.choice(len(index.postings), rng.integers(1, 50), replace=False).tolist())
        threshold = float(rng.choice([0.2, 0.4, 0.6, 0.9]))
        scores = Counter()
        for t in terms:
            for i, w in zip(*index.postings[t][:2]):
                scores[i] += w
        expected = sorted(i for i, s in scores.items() if s >= threshold - 1e-9)
        assert sorted(i for i, _ in decontaminate.block_max_wand(index, terms, threshold)) == expected


def test_quality(docs, empty):
    for r in quality.quality_rules(docs).collect():
        words = WORD.findall(r.text or "")
        grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        twice = {g for g, n in Counter(grams).items() if n > 1}
        inside = {j for i, g in enumerate(grams) if g in twice for j in (i, i + 1, i + 2)}
        lines = [x for x in (r.text or "").split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_dup_lines == len(lines) - len(set(lines)) and r.n_repeat_words == len(inside)
        assert r.base_failed == (len(words) < 50 or 100 * len(inside) > 50 * len(words))
    # A filter on a result must not run the expressions again for every element.
    assert quality.quality_rules(docs).where("kept").count() >= 1
    assert quality.quality_rules(empty).count() == 0


def test_quality_of_short_texts(spark):
    words = [f"{a}{b}" for a in ("the", "old", "town", "river", "stone") for b in ("", "s", "es", "ing")]
    plain = lambda i, n: " ".join(words[(7 * i + 3 * j + j * j // 20) % 20] for j in range(n))
    texts = [(i, plain(i, 200)) for i in range(60)]
    texts += [(100, plain(5, 60)), (101, " ".join(f"|{i}|{i * 37}|#" for i in range(60))),
              (102, " ".join(f"#{i}|" for i in range(99))), (103, plain(3, 49)), (104, ""), (105, None)]
    rows = spark.createDataFrame([(i, t, "en") for i, t in texts], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.quality_rules(rows, max_repeat_percent=100).collect()}
    for r in got.values():
        wider = max(0, 1 / math.sqrt(max(r.n_words, 1)) - 0.1)
        far = (r.class_distance or 0) > 0.25 + wider or (r.word_distance or 0) > 0.45 + wider
        assert r.kept == (not r.base_failed and not far)
    assert got[100].kept and not got[101].base_failed and not got[101].kept and not got[102].kept
    assert not got[103].kept and not got[104].kept and not got[105].kept


def test_leak_passes(spark, monkeypatch):
    """Many indexes in one pass over the texts, or in a pass each, find what is there."""
    rng = np.random.default_rng(9)
    words = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n))
    items = [(i, f"{words(n)}? {words(n)}.") for i, n in enumerate([5, 6, 9, 40, 40, 70, 8])]
    rows = [(i, words(50)) for i in range(20)]
    rows += [(100 + i, f"{words(30)} {text} {words(30)}") for i, text in items]
    rows += [(200, " ".join(text for _, text in items)), (201, None), (202, "")]
    expected = {(100 + i, i) for i, _ in items} | {(200, i) for i, _ in items}
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "ITEMS_PER_INDEX", 2)
    for limit, passes in ((1 << 30, 1), (1, None)):
        monkeypatch.setattr(decontaminate, "PASS_BYTES", limit)
        leaks = decontaminate.find_leaks(texts, benchmark)
        got = [(r._id, r.item) for r in leaks.collect()]
        assert len(got) == len(expected) and set(got) == expected
        scans = leaks._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")
        assert scans == passes if passes else scans > 2


def test_lm(docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    tokens = lambda t: WORD.findall(lower(t)) + [""]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    got = lm_score.score_texts(docs).collect()
    assert len(got) == len(rows)
    base = Counter((i, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows)
    assert Counter((r._id, round(r.base_score, 6)) for r in got) == base
    assert all(r.train_tokens == n and r.held_out == held(r._id) and r.score < 0 for r in got)
    assert lm_score.score_texts(empty).count() == 0


def test_lm_encoding_of_texts_by_slices(spark):
    """Texts larger than a slice, empty ones and words off the table, against a plain count of each."""
    table = {b"": (0, 0.5, 1), b"a": (64, 1.25, 1), b"b": (3, 2.0, 1), b"d": (5, 0.0, 0)}
    texts = ["a b c A d", "", "x y x a", None, "b " * 700_000 + "Z z q", "é a", "b c " * 200_000, "w"]
    rows = [(i, t, i % 2 == 1) for i, t in enumerate(texts)]
    base = spark.createDataFrame(rows, "_id long, _text string, _held boolean").coalesce(1)
    got = lm_score._encoded(base, spark.sparkContext.broadcast(table)).collect()
    assert sorted(r._id for r in got) == list(range(len(texts))) and len({r._row for r in got}) == len(texts)
    for r in got:
        tokens = lm_score.tokens_of((texts[r._id] or "").encode()) + [b""]
        off = Counter(t.decode() for t in tokens if t not in table)
        assert (r.n_tokens, r._held, dict(zip(r.words, r.times))) == (len(tokens), r._id % 2 == 1, off)
        assert r.n_known == sum(table[t][2] for t in tokens if t in table)
        assert r.base == pytest.approx(sum(table[t][1] for t in tokens if t in table))
        assert r.shared == pytest.approx(2.0 * tokens.count(b"b"))
        codes = np.frombuffer(r.codes, np.uint16).tolist()
        assert codes == [table[t][0] if t in table else lm_score.class_of(t) for t in tokens]


def test_lm_score(docs, monkeypatch):
    """Scores against a plain sum over tokens, whether counts are known to the tasks or joined."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    tokens = lambda t: WORD.findall(lower(t)) + [""]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    settings = lm_score.Settings(entries=70, dimensions=4)
    rng = np.random.default_rng(8)
    model = lm_score.Model(*[rng.normal(0, 1, s) for s in [(70, 4), (70, 4), (4, 4), (4, 4), (70,)]])
    monkeypatch.setattr(lm_score, "_trained", lambda *_: model)
    listed = sorted((w for w in counts if w), key=lambda w: (-counts[w], w))[:6]
    entry = lambda w: 0 if w == "" else 64 + listed.index(w) if w in listed else lm_score.class_of(w.encode())
    classes = {}
    for w, c in counts.items():
        if 0 < entry(w) < 64:
            classes.setdefault(entry(w), []).append(c)
    deal = {k: sum(v) + len(v) + 1 for k, v in classes.items()}

    def expected(text):
        total, far, near = 0.0, 0, 0
        for w in tokens(text):
            e = entry(w)
            scores = (model.context[near] @ model.near + model.context[far] @ model.far) @ model.word.T + model.bias
            total += (scores[e] - np.log(np.exp(scores).sum())) / math.log(10)
            if 0 < e < 64:
                total += math.log10((counts[w] + 1) / deal.get(e, 1))
            far, near = near, e
        return total

    plain = Counter((i, round(expected(t), 4)) for i, t in rows)
    for all_known in (True, False):
        if not all_known:  # The others' counts are joined.
            monkeypatch.setattr(lm_score, "_commonest", lambda words: [
                r for r in words.select("word", "c").collect() if r.word in (listed + [""])
            ])
        got = lm_score.score_texts(docs, settings=settings).collect()
        assert Counter((r._id, round(r.score, 4)) for r in got) == plain


def test_lm_commonest(spark, monkeypatch):
    rows = [("", 1, 0), ("a", 90, 10), ("b", 50, 0), ("c", 49, 1), ("d", 3, 0), ("e", 3, 0), ("f", 0, 3)]
    words = spark.createDataFrame(rows, "word string, c long, other long")
    monkeypatch.setattr(lm_score, "KNOWN_WORDS", 4)
    assert sorted(r.word for r in lm_score._commonest(words)) == ["", "a", "b", "c"]
    monkeypatch.setattr(lm_score, "KNOWN_WORDS", 100)
    assert len(lm_score._commonest(words)) == len(rows)


def test_lm_probabilities_sum_to_one():
    settings = lm_score.Settings(entries=80, dimensions=4)
    model = lm_score.first_model(np.full(80, 1 / 80), settings)
    every = np.arange(80)
    logs = lm_score.log10_probabilities(model, np.full(80, 3), np.full(80, 5), every)
    assert (10 ** logs).sum() == pytest.approx(1)


def test_shards(docs, empty):
    rows = sharding.shard_by_bytes(docs, 4).collect()
    sizes, slots = Counter(), {}
    for r in rows:
        sizes[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    expected = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in TEXTS)
    assert Counter((r._id, r["size"], r.text_crc32) for r in rows) == expected
    assert sharding.shard_by_bytes(empty).count() == 0


def test_stages(spark, docs, empty, tmp_path):
    spark.createDataFrame([(1, "what is it? nothing at all")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for table in (plain, plain.where("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, str(tmp_path))
            assert out.columns == plain.columns, name
            out.count()
    assert corpus_pipeline.STAGES[-1][1](spark, plain, str(tmp_path)).count() >= plain.count()
