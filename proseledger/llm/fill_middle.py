"""Fill-in-the-middle by displacement: every byte moves by a shift that holds for its whole segment.

The texts of a batch lie in one buffer. Where a line ends is found once for all
of them. The two cuts of a text make three segments, and a form only says how
far each segment moves. The shifts are written as differences at the places
where they change; their running sum gives every byte its place in the output,
and one scatter moves all texts of the batch. Going back, the marks are found
in the output alone, the same differences are made from them, and one gather
fetches every byte from where it went.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ID, TEXT, as_bytes, map_batches, narrow, slices

PLAIN, PSM, SPM = 0, 1, 2
FORMS = ["plain", "psm", "spm"]
# So many bytes have their shifts written out at a time.
WINDOW = 1 << 20
SCHEMA = f"{ID} long, n long, form string, prefix_chars long, middle_chars long, output string"


class Marks(NamedTuple):
    """What stands before the prefix, the suffix and the middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def checked(self) -> Marks:
        """The marks, if none can arise where a text meets a mark."""
        if not all(self) or any(
            a[0] in b[1:] or (a is not b and b.startswith(a)) for a in self for b in self
        ):
            raise ValueError("a mark's first character must not occur later in any, and none may start another")
        return self


def draws(id_col: str, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the sha256 of ``seed:id`` (a NULL id: ``seed:``)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def places_of(buffer: np.ndarray, mark: bytes) -> np.ndarray:
    """Where a string of bytes starts in a buffer."""
    end = len(buffer) - len(mark) + 1
    if end <= 0:
        return np.empty(0, np.int64)
    at = np.flatnonzero(buffer[:end] == mark[0])
    for i, byte in enumerate(mark[1:], 1):
        at = at[buffer[at + i] == byte]
    return at


def inside(places: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Those of sorted places that start and end within one text, with the text's number."""
    text = np.searchsorted(starts, places, "right") - 1
    whole = places + width <= ends[text] if len(places) else np.zeros(0, bool)
    return places[whole], text[whole]


def shifts(at: np.ndarray, by: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Ranges of a buffer with the shift of every byte: running sums of the differences ``by`` at ``at``.

    Differences at one place add up, as those of empty segments do.
    """
    order = np.argsort(at, kind="stable")
    at, by = at[order], by[order]
    before = 0
    for begin in range(0, size, WINDOW):
        end = min(size, begin + WINDOW)
        first, last = np.searchsorted(at, [begin, end])
        difference = np.zeros(end - begin, np.int64)
        np.add.at(difference, at[first:last] - begin, by[first:last])
        if len(difference):
            difference[0] += before
        moved = np.cumsum(difference, out=difference)
        before = int(moved[-1])
        yield begin, end, moved


def _differences(starts: Sequence[np.ndarray], moves: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Differences at the starts of consecutive segments, of which each moves by so much.

    The segments of the texts follow each other: ``starts[k][i]`` is where segment k of text i starts.
    """
    at = np.stack(starts, 1).ravel()
    move = np.stack(moves, 1).ravel()
    return at, np.diff(move, prepend=0)


def _joined(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts one after the other, and where each starts and ends."""
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), starts, ends


class Cut(NamedTuple):
    """Where the middle and the suffix of each text start, its units and its form."""

    middle: np.ndarray
    suffix: np.ndarray
    units: np.ndarray
    form: np.ndarray


def cut(buffer, starts, ends, drawn: Sequence[np.ndarray], percent: int, spm_percent: int, marks: Marks) -> Cut:
    """Cut each text before two of its lines, drawn by the first two numbers; the others draw the form."""
    breaks = np.flatnonzero(buffer == 10)
    first, last = np.searchsorted(breaks, starts), np.searchsorted(breaks, ends)
    whole = last - first
    open_end = np.zeros(len(starts), bool)
    some = ends > starts
    open_end[some] = buffer[ends[some] - 1] != 10
    units = whole + open_end
    one, two = drawn[0] % (units + 1), drawn[1] % (units + 1)

    def after(count: np.ndarray) -> np.ndarray:
        """Where so many units of each text have ended."""
        end = np.where(count > whole, ends, starts)
        lines = (count > 0) & (count <= whole)
        end[lines] = breaks[(first + count - 1)[lines]] + 1
        return end

    form = np.where(drawn[3] % 100 < spm_percent, SPM, PSM)
    form[(drawn[2] % 100 >= percent) | ~some] = PLAIN
    for mark in marks:
        raw = mark.encode()
        form[inside(places_of(buffer, raw), starts, ends, len(raw))[1]] = PLAIN
    return Cut(after(np.minimum(one, two)), after(np.maximum(one, two)), units, form)


def rearrange(buffer, starts, ends, made: Cut, marks: Marks) -> tuple[np.ndarray, np.ndarray]:
    """The outputs one after the other, and where each ends."""
    p, s, m = (len(mark.encode()) for mark in marks)
    is_plain, is_spm = made.form == PLAIN, made.form == SPM
    prefix, middle, suffix = made.middle - starts, made.suffix - made.middle, ends - made.suffix
    sizes = (ends - starts) + np.where(is_plain, 0, p + s + m)
    out_ends = np.cumsum(sizes)
    out_starts = out_ends - sizes
    base = out_starts - starts
    head = np.where(is_spm, s + suffix + p, p)
    moves = [
        base + np.where(is_plain, 0, head),
        base + np.where(is_plain, 0, p + s + m + suffix),
        base + np.where(is_plain, 0, np.where(is_spm, s - prefix - middle, p + s - middle)),
    ]
    out = np.empty(int(out_ends[-1]) if len(out_ends) else 0, np.uint8)
    for begin, end, moved in shifts(*_differences([starts, made.middle, made.suffix], moves), len(buffer)):
        moved += np.arange(begin, end)
        out[moved] = buffer[begin:end]
    marked = ~is_plain
    before = [
        out_starts + np.where(is_spm, s + suffix, 0),
        out_starts + np.where(is_spm, 0, p + prefix),
        out_starts + p + s + prefix + suffix,
    ]
    for mark, at in zip(marks, before):
        raw = np.frombuffer(mark.encode(), np.uint8)
        out[at[marked][:, None] + np.arange(len(raw))] = raw
    return out, out_ends


def put_back(out, starts, ends, form: np.ndarray, marks: Marks) -> tuple[np.ndarray, np.ndarray]:
    """The texts that outputs of these forms were made from, and where each ends."""
    widths = [len(mark.encode()) for mark in marks]
    marked = form != PLAIN
    at = []
    for mark, width in zip(marks, widths):
        found, text = inside(places_of(out, mark.encode()), starts, ends, width)
        found, text = found[marked[text]], text[marked[text]]
        if not np.array_equal(text, np.flatnonzero(marked)):
            raise ValueError("an output without exactly one of each mark has no text it was made from")
        place = starts.copy()
        place[text] = found
        at.append(place)
    p, s, m = (np.where(marked, w, 0) for w in widths)
    is_spm = form == SPM
    prefix_at, suffix_at, middle_at = at[0] + p, at[1] + s, at[2] + m
    middle = np.where(marked, ends - middle_at, 0)
    prefix = np.where(marked, np.where(is_spm, at[2], at[1]) - prefix_at, 0)
    suffix = np.where(marked, np.where(is_spm, at[0], at[2]) - suffix_at, 0)
    sizes = np.where(marked, prefix + middle + suffix, ends - starts)
    text_ends = np.cumsum(sizes)
    text_starts = text_ends - sizes
    # From each byte of the text to where it lies in the output; a plain text is one suffix.
    cuts = [text_starts, text_starts + prefix, text_starts + prefix + middle]
    moves = [
        prefix_at - cuts[0],
        np.where(marked, middle_at, starts) - cuts[1],
        np.where(marked, suffix_at, starts) - cuts[2],
    ]
    text = np.empty(int(text_ends[-1]) if len(text_ends) else 0, np.uint8)
    for begin, end, moved in shifts(*_differences(cuts, moves), len(text)):
        moved += np.arange(begin, end)
        text[begin:end] = out[moved]
    return text, text_ends


def _strings(buffer: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The texts of a buffer as strings, without a copy for each."""
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    made = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(buffer))
    return made.cast(pa.string())


def _characters(buffer: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Code points between two places of UTF-8, for many pairs of places."""
    upto = np.zeros(len(buffer) + 1, np.int64)
    np.cumsum((buffer & 0xC0) != 0x80, out=upto[1:])
    return upto[end] - upto[begin]


def fill_in_middle(
    df: DataFrame,
    seed: int = 7,
    percent: int = 100,
    spm_percent: int = 50,
    marks: Marks = Marks(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rearrange each text at two cuts between its lines so that its middle comes last.

    Rows ``_id, n, form, prefix_chars, middle_chars, output``, one per row. A text has
    ``n`` units (lines with their break; what follows the last break is one too). Two
    numbers drawn from seed and id are the units before the middle and before the suffix.
    ``form`` is psm (marks and parts in the order prefix, suffix, middle), spm (suffix,
    prefix, middle; ``spm_percent`` of the rearranged texts) or plain: ``output`` is the text. Plain are
    texts that are empty or hold a mark, and those beyond ``percent``.

    Rows are worked on where they are read, in buffers of a few megabytes or one longer text;
    nothing is shuffled. A very long text takes a few times its size, as shifts are
    written out for a window of it at a time. A NULL text is empty. A NULL id draws as an empty one.
    Rows that share an id share the draws. An empty table gives an empty
    result; other columns are ignored. ``restore`` undoes it.
    """
    marks = marks.checked()
    names = ["_h1", "_h2", "_h3", "_h4"]
    drawn = narrow(df, id_col, text_col).select(
        ID, TEXT, *[h.alias(name) for h, name in zip(draws(ID, seed), names)]
    )

    def rows(batches):
        for batch in batches:
            texts = as_bytes(batch.column(TEXT))
            numbers = [batch.column(name).to_numpy(zero_copy_only=False) for name in names]
            for a, b in slices(texts):
                buffer, starts, ends = _joined(texts[a:b])
                made = cut(buffer, starts, ends, [h[a:b] for h in numbers], percent, spm_percent, marks)
                out, out_ends = rearrange(buffer, starts, ends, made, marks)
                is_plain = made.form == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(ID)[a:b], pa.array(made.units),
                        pa.array(np.array(FORMS, object)[made.form], pa.string()),
                        pa.array(_characters(buffer, starts, made.middle), mask=is_plain),
                        pa.array(_characters(buffer, made.middle, made.suffix), mask=is_plain),
                        _strings(out, out_ends),
                    ],
                    [ID, "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return map_batches(drawn, rows, SCHEMA.replace("long", dict(drawn.dtypes)[ID], 1))


def restore(df: DataFrame, marks: Marks = Marks(), output_col: str = "output", form_col: str = "form") -> DataFrame:
    """Add ``restored``: the exact text that each output was made from, found from output and form alone.

    A NULL output is an empty one, a NULL form is plain. An output of another form that has
    not one of each mark ends the job. A column ``restored`` of the caller's is replaced.
    """
    marks = marks.checked()
    kept = df.drop("restored")
    names = {c: f"_c{i}" for i, c in enumerate(kept.columns)}

    def rows(batches):
        for batch in batches:
            texts = as_bytes(batch.column(names[output_col]))
            form = np.array([FORMS.index(f or "plain") for f in batch.column(names[form_col]).to_pylist()], np.int64)
            for a, b in slices(texts):
                buffer, starts, ends = _joined(texts[a:b])
                text, text_ends = put_back(buffer, starts, ends, form[a:b], marks)
                yield pa.RecordBatch.from_arrays(
                    [*[c[a:b] for c in batch.columns], _strings(text, text_ends)],
                    [*names.values(), "restored"],
                )

    kinds = dict(kept.dtypes)
    schema = ", ".join([*[f"{names[c]} {kinds[c]}" for c in kept.columns], "restored string"])
    made = map_batches(kept.select([F.col(f"`{c}`").alias(n) for c, n in names.items()]), rows, schema)
    return made.select(*[F.col(n).alias(c) for c, n in names.items()], "restored")
