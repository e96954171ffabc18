"""Fill-in-middle documents: lines split into prefix, middle and suffix, with
line ends found a machine word at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_HIGH = np.uint64(0x8080808080808080)
_ENDS = np.uint64(0x0A0A0A0A0A0A0A0A)
_ONE, _EIGHT = np.uint64(1), np.uint64(8)


def words_of(raw: bytes) -> np.ndarray:
    """The bytes as little-endian 64-bit words, zeros at the end and one word more."""
    return np.frombuffer(raw + bytes(16 - len(raw) % 8), "<u8")


def line_end_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a line end. Adding 0x7F to the low
    seven bits of a byte sets its high bit unless they are zero, and never
    carries into the next byte."""
    x = words ^ _ENDS
    return ~(((x & _LOW7) + _LOW7) | x | _LOW7)


def inner_byte_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte inside a character (10xxxxxx)."""
    return words & ~(words << _ONE) & _HIGH


class Marked:
    """Rank and select over marked bytes, by words."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before each byte place."""
        word = at >> 3
        below = (_ONE << (_EIGHT * (at & 7).astype(np.uint64))) - _ONE
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The place of the k-th mark (from 0): its word by a search over the
        running counts, then its byte by clearing the marks below it."""
        word = np.searchsorted(self.before, k, side="right") - 1
        left = k - self.before[word]
        mark = self.marks[word]
        for done in range(int(left.max(initial=0))):
            mark = np.where(left > done, mark & (mark - _ONE), mark)
        lowest = mark & (~mark + _ONE)
        return word * 8 + (np.bitwise_count(lowest - _ONE) >> 3)


def cuts(texts: list[bytes], first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per text its units (lines, the last one perhaps without an end), the
    byte places after ``first % (units + 1)`` and ``second % (units + 1)``
    units, the smaller first, and the characters before each."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    raw = b"".join(texts)
    words = words_of(raw)
    lines, inner = Marked(line_end_marks(words)), Marked(inner_byte_marks(words))
    base = lines.rank(starts)
    open_end = (sizes > 0) & (np.frombuffer(raw + b"\n", np.uint8)[ends - 1] != 10)
    n = lines.rank(ends) - base + open_end
    a, b = first % (n + 1), second % (n + 1)
    got = [n]
    for units in (np.minimum(a, b), np.maximum(a, b)):
        place = np.where(units == n, sizes, 0)
        some = np.flatnonzero((units > 0) & (units < n))
        place[some] = lines.select(base[some] + units[some] - 1) + 1 - starts[some]
        got += [place, place - (inner.rank(starts + place) - inner.rank(starts))]
    return tuple(got)


def fill_in_middle(docs: DataFrame, text: str = "text", id_col: str = "doc_id", salt: str = "7",
                   share: int = 100, spm_share: int = 50) -> DataFrame:
    """The rows of ``docs`` with n (lines, long), form (plain, psm or spm),
    prefix_chars, middle_chars (null if plain) and output.

    The cuts and the form come from the sha256 of ``salt:id``, so reruns agree
    and rows of one id are cut alike; a null id counts as an empty one. Plain:
    an empty or null text (output is empty then), one that holds a mark
    itself, and all but ``share`` percent; ``spm_share`` percent of the others
    put the suffix first. A text of one line is cut too: parts may be empty.
    An input column that is named like a new one is replaced. A batch of rows
    is one buffer, searched as 64-bit words; no state grows with the table.
    """
    new = T.StructType.fromDDL("n long, form string, prefix_chars long, middle_chars long, output string")
    taken = {f.name.lower() for f in new}
    names = docs.columns
    keep = [i for i, c in enumerate(names) if c.lower() not in taken]
    schema = T.StructType([docs.schema[i] for i in keep] + list(new))
    arrow = to_arrow_schema(schema)
    last = len(names)
    rows = docs.toDF(*[f"c{i}" for i in range(last)])
    rows = rows.withColumns({f"c{last}": F.col(f"c{names.index(text)}").cast("binary"),
                             f"c{last + 1}": F.col(f"c{names.index(id_col)}").cast("string")})
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or b"" for t in b.column(last).to_pylist()]
            digests = [hashlib.sha256(f"{salt}:{'' if i is None else i}".encode()).digest() for i in b.column(last + 1).to_pylist()]
            h = np.frombuffer(b"".join(digests), ">u4").reshape(-1, 8).astype(np.int64)
            n, a, a_chars, m, m_chars = cuts(texts, h[:, 0], h[:, 1])
            form, out = [], []
            for t, x, y, plain, spm in zip(texts, a.tolist(), m.tolist(), (h[:, 2] % 100 >= share).tolist(),
                                           (h[:, 3] % 100 < spm_share).tolist()):
                if plain or not t or any(k in t for k in marks):
                    form.append("plain")
                    out.append(t)
                elif spm:
                    form.append("spm")
                    out.append(b"".join([marks[1], t[y:], marks[0], t[:x], marks[2], t[x:y]]))
                else:
                    form.append("psm")
                    out.append(b"".join([marks[0], t[:x], marks[1], t[y:], marks[2], t[x:y]]))
            cut = np.array([f == "plain" for f in form], bool)
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in keep] + [pa.array(n), pa.array(form, pa.string()), pa.array(a_chars, mask=cut),
                                               pa.array(m_chars - a_chars, mask=cut), pa.array(out, pa.binary()).view(pa.string())],
                names=arrow.names)

    return rows.mapInArrow(run, schema)


def restored(form: Column, output: Column) -> Column:
    """The text behind an output: a text that holds a mark is plain, so the marks part it."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))
