"""A log-bilinear language model, trained by noise-contrastive estimation, and its scores of texts.

The next word's vector is predicted as the sum of the vectors of the two words
before it, each through a matrix of its own; a word's score is the product of
its vector with the prediction, plus a bias. Words outside a short list share
entries by how they begin, and an entry's probability is dealt out by its words'
counts, so that all tokens, seen or not, have probabilities that sum to one.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ID, TEXT, as_bytes, map_batches, slices, store

# The end of a text, as a token: no word is empty.
END = ""
# Entries: the end, classes of words off the short list, then the short list.
END_ID, CLASSES = 0, 63
FIRST_LISTED = 1 + CLASSES
# At most so many words' counts are had by every task; the counts of others are joined.
KNOWN_WORDS = 100_000
# Counters in tasks are written out at this size.
MAX_COUNTER = 200_000
# So many bytes of text are cut into tokens at a time, or one longer text.
ENCODED_BYTES = 1 << 20


class Settings(NamedTuple):
    """Size and training of the model."""

    entries: int = 512
    dimensions: int = 16
    rounds: int = 2
    noise: int = 32
    batch: int = 4096
    rate: float = 0.15
    # Contexts and next words of one slice of texts, combined before training.
    slice_tokens: int = 1 << 20


class Model(NamedTuple):
    """Vectors of context words and of predicted words, two context matrices, biases."""

    context: np.ndarray
    word: np.ndarray
    near: np.ndarray
    far: np.ndarray
    bias: np.ndarray

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self])

    @classmethod
    def of(cls, flat: np.ndarray, entries: int, dimensions: int) -> Model:
        shapes = [(entries, dimensions), (entries, dimensions), (dimensions, dimensions),
                  (dimensions, dimensions), (entries,)]
        ends = np.cumsum([math.prod(s) for s in shapes])
        return cls(*[p.reshape(s).copy() for p, s in zip(np.split(flat, ends[:-1]), shapes)])


def tokens_of(text: bytes) -> list[bytes]:
    """Words of a text, A-Z in lower case."""
    return text.translate(ASCII_LOWER).split()


def class_of(word: bytes) -> int:
    """The entry of a word that is not on the short list: by its first three bytes."""
    return 1 + zlib.crc32(word[:3]) % CLASSES


def first_model(shares: np.ndarray, settings: Settings) -> Model:
    rng = np.random.default_rng(7)
    n, d = settings.entries, settings.dimensions
    small = lambda *shape: rng.normal(0, 0.1, shape)
    return Model(small(n, d), small(n, d), np.eye(d), np.eye(d) * 0.5,
                 np.log(np.maximum(shares, 1e-9)))


def train(model: Model, far, near, word, weight, shares: np.ndarray, settings: Settings, seed: int) -> Model:
    """One pass over contexts and next words with weights, by noise-contrastive estimation.

    The words of a batch are told apart from noise words drawn by their shares;
    all of a batch share the noise. Steps are scaled by running squares of gradients.
    """
    rng = np.random.default_rng(seed)
    params = [p.copy() for p in model]
    squares = [np.full_like(p, 1e-3) for p in params]
    context, out, c_near, c_far, bias = params
    order = rng.permutation(len(word))
    log_noise = np.log(settings.noise * np.maximum(shares, 1e-12))
    weight = weight / weight.mean()
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    def step(i, gradient):
        squares[i] += gradient ** 2
        params[i] -= settings.rate * gradient / np.sqrt(squares[i])

    def gathered(rows, values):
        """Sums of values by entry; a batch touches most entries, so whole tables are stepped."""
        return np.stack([np.bincount(rows, v, settings.entries) for v in values.T], axis=1)

    for begin in range(0, len(order), settings.batch):
        at = order[begin:begin + settings.batch]
        f, n, w = far[at], near[at], word[at]
        u = (weight[at] / len(at))[:, None]
        vf, vn = context[f], context[n]
        predicted = vn @ c_near + vf @ c_far
        noise = rng.choice(len(shares), settings.noise, p=shares)
        good = np.einsum("ij,ij->i", predicted, out[w]) + bias[w] - log_noise[w]
        bad = predicted @ out[noise].T + bias[noise] - log_noise[noise]
        d_good = (sigmoid(good) - 1)[:, None] * u
        d_bad = sigmoid(bad) * u
        d_predicted = d_good * out[w] + d_bad @ out[noise]
        d_near, d_far = vn.T @ d_predicted, vf.T @ d_predicted
        d_vn, d_vf = d_predicted @ c_near.T, d_predicted @ c_far.T
        rows = np.concatenate([w, noise])
        step(1, gathered(rows, np.concatenate([d_good * predicted, d_bad.T @ predicted])))
        step(4, np.bincount(rows, np.concatenate([d_good[:, 0], d_bad.sum(axis=0)]), settings.entries))
        step(2, d_near)
        step(3, d_far)
        step(0, gathered(np.concatenate([n, f]), np.concatenate([d_vn, d_vf])))
    return Model(*params)


def log10_probabilities(model: Model, far: np.ndarray, near: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Normalised log10 probabilities of entries after their contexts; each context is worked out once."""
    entries = len(model.bias)
    contexts, back = np.unique(far.astype(np.int64) * entries + near, return_inverse=True)
    out = np.empty(len(word))
    order = np.argsort(back, kind="stable")
    edges = np.searchsorted(back[order], np.arange(0, len(contexts) + 1024, 1024))
    for i, begin in enumerate(range(0, len(contexts), 1024)):
        some = contexts[begin:begin + 1024]
        f, n = model.context[some // entries], model.context[some % entries]
        scores = (n @ model.near + f @ model.far) @ model.word.T + model.bias
        top = scores.max(axis=1, keepdims=True)
        norm = top[:, 0] + np.log(np.exp(scores - top).sum(axis=1))
        rows = order[edges[i]:edges[i + 1]]
        local = back[rows] - begin
        out[rows] = (scores[local, word[rows]] - norm[local]) / math.log(10)
    return out


def _contexts(codes: list[np.ndarray]):
    """Entries with the two before them; the end of a text also stands before it."""
    word = np.concatenate(codes).astype(np.int64)
    starts = np.cumsum([0] + [len(c) for c in codes[:-1]])
    near = np.concatenate([[END_ID], word[:-1]])
    near[starts] = END_ID
    far = np.concatenate([[END_ID, END_ID], word[:-2]])[:len(word)]
    far[starts] = END_ID
    seconds = starts[np.array([len(c) for c in codes]) > 1] + 1
    far[seconds] = END_ID
    return far, near, word


def _slices(rows: list[np.ndarray], limit: int):
    begin = size = 0
    for at, row in enumerate(rows):
        if at > begin and size + len(row) > limit:
            yield begin, at
            begin, size = at, 0
        size += len(row)
    if begin < len(rows):
        yield begin, len(rows)


def _word_counts(base: DataFrame) -> DataFrame:
    """Per word: how often in training texts and in all texts. Texts end with ``END``."""

    def rows(batches):
        counters = Counter(), Counter()

        def out():
            words = list(counters[0].keys() | counters[1].keys())
            trained, other = (list(map(counter.get, words, repeat(0))) for counter in counters)
            for counter in counters:
                counter.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()).cast(pa.string()), pa.array(trained, pa.int64()),
                 pa.array(other, pa.int64())], ["word", "trained", "other"],
            )

        for batch in batches:
            held = batch.column("_held").to_pylist()
            for text, is_held in zip(as_bytes(batch.column(TEXT)), held):
                counter = counters[is_held]
                counter.update(tokens_of(text))
                counter[b""] += 1
                if len(counters[0]) + len(counters[1]) > MAX_COUNTER:
                    yield out()
        yield out()

    made = map_batches(base.select("_held", TEXT), rows, "word string, trained long, other long")
    return store(
        made.groupBy("word").agg(F.sum("trained").alias("c"), F.sum("other").alias("other")), "words"
    )


def _commonest(words: DataFrame) -> list:
    """The end and the commonest words, at most ``KNOWN_WORDS``: those above a step of counts.

    A histogram of the counts, eight steps to each doubling, says where to cut;
    only what is above is collected. A step is taken whole or not at all.
    """
    counted = words.withColumn("all", F.col("c") + F.col("other"))
    step = F.floor(F.log2("all") * 8).cast("int")
    total, cut = 0, None
    for row in counted.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > KNOWN_WORDS:
            break
        cut = row.step
    above = F.lit(False) if cut is None else step >= cut
    return counted.where(above | (F.col("word") == END)).select("word", "c").collect()


def _encoded(base: DataFrame, known) -> DataFrame:
    """Per text: its entries, the known part of its sums, and its words whose counts must be joined."""
    schema = (f"{ID} {dict(base.dtypes)[ID]}, _held boolean, _row long, n_tokens long, n_known long, "
              "base double, shared double, codes binary, words array<string>, times array<long>")

    def rows(batches):
        from pyspark import TaskContext

        table = known.value
        place = dict(zip(table, range(len(table)))).get
        # By place; the last entry stands for words that are not in the table.
        code = np.array([c for c, _, _ in table.values()] + [0], np.uint16)
        log_count = np.array([x for _, x, _ in table.values()] + [0.0])
        is_known = np.array([k for _, _, k in table.values()] + [0], np.int64)
        shared_log = np.where((code > END_ID) & (code < FIRST_LISTED), log_count, 0.0)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = as_bytes(batch.column(TEXT))
            for begin, end in slices(texts, ENCODED_BYTES):
                tokens, ends = [], []
                for text in texts[begin:end]:
                    tokens += tokens_of(text)
                    tokens.append(b"")
                    ends.append(len(tokens))
                at = np.fromiter(map(place, tokens, repeat(len(table))), np.int64, len(tokens))
                codes = code[at]
                # Words off the table, by text.
                off = np.flatnonzero(at == len(table))
                others = [tokens[i] for i in off.tolist()]
                classes = {word: class_of(word) for word in set(others)}
                codes[off] = [classes[word] for word in others]
                cuts = np.searchsorted(off, ends).tolist()
                rare = [Counter(others[a:b]) for a, b in zip([0] + cuts, cuts)]
                starts = [0] + ends[:-1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(ID).slice(begin, end - begin), batch.column("_held").slice(begin, end - begin),
                     pa.array(np.arange(row, row + end - begin)), pa.array(np.diff([0] + ends)),
                     *[pa.array(np.add.reduceat(values[at], starts)) for values in (is_known, log_count, shared_log)],
                     pa.array([codes[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                     pa.array([[w.decode() for w in counts] for counts in rare], pa.list_(pa.string())),
                     pa.array([list(counts.values()) for counts in rare], pa.list_(pa.int64()))],
                    [ID, "_held", "_row", "n_tokens", "n_known", "base", "shared", "codes", "words", "times"],
                )
                row += end - begin

    return store(map_batches(base, rows, schema), "encoded")


def _trained(encoded: DataFrame, shares: np.ndarray, settings: Settings) -> Model:
    """Every task trains on its own texts, then the models are averaged by their tokens; in rounds."""
    context = encoded.sparkSession.sparkContext
    model = first_model(shares, settings)
    texts = encoded.where("not _held").select("codes")
    for turn in range(settings.rounds):
        shared = context.broadcast(model)

        def rows(batches, turn=turn, shared=shared):
            from pyspark import TaskContext

            own, total = shared.value, 0
            seed = turn * 1_000_003 + TaskContext.get().partitionId()
            for batch in batches:
                codes = [np.frombuffer(c, np.uint16) for c in as_bytes(batch.column(0))]
                for begin, end in _slices(codes, settings.slice_tokens):
                    far, near, word = _contexts(codes[begin:end])
                    packed, counts = np.unique(
                        (far * settings.entries + near) * settings.entries + word, return_counts=True
                    )
                    far, rest = np.divmod(packed, settings.entries ** 2)
                    near, word = np.divmod(rest, settings.entries)
                    own = train(own, far, near, word, counts.astype(float), shares, settings, seed)
                    seed += 7_919
                    total += int(counts.sum())
            if total:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(own.flat().size)), pa.array(own.flat() * total),
                     pa.array(np.full(own.flat().size, total))], ["i", "x", "n"],
                )

        sums = (
            map_batches(texts, rows, "i long, x double, n long")
            .groupBy("i").agg((F.sum("x") / F.sum("n")).alias("x"))
        )
        # One number per parameter.
        table = sums.toArrow()
        if table.num_rows == 0:
            return model
        flat = np.empty(table.num_rows)
        flat[table.column("i").to_numpy()] = table.column("x").to_numpy()
        model = Model.of(flat, settings.entries, settings.dimensions)
    return model


def held_out(id_column) -> F.Column:
    """Whether crc32 of the id as text, modulo 7, is 2."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % 7 == 2


def score_texts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """Base-10 log probabilities of every whole text, learning from those not held out.

    Held out: crc32 of the id (as text, NULL as empty) modulo 7 is 2. Tokens are
    words, A-Z in lower case, and an end. Returns one row per input row: ``_id,
    held_out, n_tokens, n_known`` (tokens seen in training), ``train_tokens``,
    ``base_score`` (unigrams with one added to each count, unseen words as one
    more) and ``score`` (the model's).

    Counts, short list and model come from all training texts. Tasks hold the
    commonest words' counts; rarer words are joined with theirs. The model has a
    fixed number of parameters; tasks train it on their own texts and only
    parameters are brought together. NULL and empty texts are an end only. With
    no training text the counts are zero and the model is the uniform one.
    Repeated rows are texts of their own. An empty table gives an empty result.
    Other columns are ignored.
    """
    spark = df.sparkSession
    base = df.select(
        F.col(id_col).alias(ID), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(TEXT),
        held_out(F.col(id_col)).alias("_held"),
    )
    words = _word_counts(base)
    train_tokens, types = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)
    ).first()
    top = _commonest(words)
    listed = sorted((r for r in top if r.word != END and r.c > 0), key=lambda r: (-r.c, r.word))
    listed = listed[:settings.entries - FIRST_LISTED]
    end_count = next((r.c for r in top if r.word == END), 0)
    codes = {END: END_ID} | {r.word: FIRST_LISTED + i for i, r in enumerate(listed)}
    known = spark.sparkContext.broadcast({
        word: (codes.get(r.word, class_of(word)), math.log10(r.c + 1), int(r.c > 0))
        for r in top for word in [r.word.encode()]
    })
    # Tokens and words of the classes: all words, less those that are listed.
    first_bytes = F.substring(F.encode("word", "utf-8"), 1, 3)
    of_class = {
        r.entry: [r.tokens, r.types]
        for r in words.where("c > 0").groupBy((F.crc32(first_bytes) % CLASSES + 1).alias("entry"))
        .agg(F.sum("c").alias("tokens"), F.count("*").alias("types")).collect()
    }
    for word, count in [(END, end_count)] * (end_count > 0) + [(r.word, r.c) for r in listed]:
        entry = of_class[class_of(word.encode())]
        entry[0] -= count
        entry[1] -= 1
    counts = np.zeros(settings.entries)
    deal = np.zeros(settings.entries)
    counts[END_ID] = end_count + 1
    for entry in range(1, FIRST_LISTED):
        # Dealt out like the base: counts plus one, and one unseen word.
        tokens, kinds = of_class.get(entry, (0, 0))
        counts[entry] = tokens + kinds + 1
        deal[entry] = math.log10(tokens + kinds + 1)
    counts[FIRST_LISTED:FIRST_LISTED + len(listed)] = [r.c + 1 for r in listed]
    shares = counts / counts.sum()

    encoded = _encoded(base, known)
    model = spark.sparkContext.broadcast(_trained(encoded, shares, settings))

    def rows(batches):
        for batch in batches:
            codes = [np.frombuffer(c, np.uint16) for c in as_bytes(batch.column("codes"))]
            sums, dealt = [], []
            for begin, end in _slices(codes, settings.slice_tokens):
                far, near, word = _contexts(codes[begin:end])
                lengths = [len(c) for c in codes[begin:end]]
                starts = np.cumsum([0] + lengths[:-1])
                sums.append(np.add.reduceat(log10_probabilities(model.value, far, near, word), starts))
                dealt.append(np.add.reduceat(deal[word], starts))
            if sums:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row"), pa.array(np.concatenate(sums)),
                     pa.array(np.concatenate(dealt))], ["row", "lm", "dealt"],
                )

    scored = map_batches(encoded.select("_row", "codes"), rows, "row long, lm double, dealt double")
    counted = words.where("c > 0").select("word", "c")
    rare = (
        encoded.select("_row", F.explode(F.arrays_zip("words", "times")).alias("_w"))
        .select("_row", F.col("_w.words").alias("_word"), F.col("_w.times").alias("_times"))
        .join(counted, F.col("_word") == F.col("word"))
        .groupBy(F.col("_row").alias("_rare_row"))
        .agg(F.sum(F.col("_times") * F.log10(F.col("c") + 1)).alias("_rare"),
             F.sum("_times").alias("_rare_known"))
    )
    rare_sum = F.coalesce("_rare", F.lit(0.0))
    return (
        encoded.drop("codes", "words", "times")
        .join(scored, F.col("_row") == F.col("row"))
        .join(rare, F.col("_row") == F.col("_rare_row"), "left")
        .select(
            ID,
            F.col("_held").alias("held_out"),
            "n_tokens",
            (F.col("n_known") + F.coalesce("_rare_known", F.lit(0))).alias("n_known"),
            F.lit(int(train_tokens)).cast("long").alias("train_tokens"),
            (F.col("base") + rare_sum
             - F.col("n_tokens") * math.log10(train_tokens + types + 1)).alias("base_score"),
            (F.col("lm") + F.col("shared") + rare_sum - F.col("dealt")).alias("score"),
        )
    )
