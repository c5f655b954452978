"""Fill-in-middle transformation on a piece table.

A document is a list of descriptors (buffer, start, end) over two buffers that are never
written: its own text and the three sentinels. Cutting splits descriptors, an arrangement
permutes the pieces and puts sentinels before them, the inverse permutation restores the
text; digests read the pieces one after another. Text is copied once at most, for the output.

Texts are cut into units: a run of A-Z and a-z, or any other single code point.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tachoflow.llm.words import Texts, slices

SENTINELS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
#: Order in which a form shows the pieces; each follows its sentinel.
ARRANGEMENTS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
#: Order of the pieces in the text.
PIECES = ("prefix", "middle", "suffix")
PLAIN_FROM = 90
SPM_BELOW = 20
SEED = "1:"

_BYTES = np.arange(256)
_LETTER = ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122))
#: Bytes that begin a code point in UTF-8.
_LEAD = (_BYTES & 0xC0) != 0x80

OUTPUT_DDL = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, "
              "output_sha256 string, restored_sha256 string")


class Descriptor(NamedTuple):
    """Bytes start (inclusive) to end of a buffer; role is the piece they are, or 'sentinel'."""

    buffer: memoryview
    start: int
    end: int
    role: str

    def bytes(self) -> memoryview:
        return self.buffer[self.start:self.end]


class PieceTable:
    """Descriptors in reading order. Every operation gives a new list over the same buffers."""

    def __init__(self, descriptors: list[Descriptor]) -> None:
        self.descriptors = descriptors

    @classmethod
    def of(cls, text: memoryview, role: str = "text") -> PieceTable:
        return cls([Descriptor(text, 0, len(text), role)])

    def cut(self, places: list[int]) -> PieceTable:
        """Split at these places (ascending byte positions of the whole)."""
        out, at, todo = [], 0, list(places)
        for d in self.descriptors:
            start = d.start
            while todo and todo[0] <= at + d.end - d.start:
                place = d.start + todo.pop(0) - at
                out.append(d._replace(start=start, end=place))
                start = place
            out.append(d._replace(start=start))
            at += d.end - d.start
        return PieceTable(out)

    def named(self, roles: tuple[str, ...]) -> PieceTable:
        return PieceTable([d._replace(role=r) for d, r in zip(self.descriptors, roles, strict=True)])

    def arranged(self, form: str) -> PieceTable:
        """Pieces in the order of the form, each behind its sentinel."""
        by_role, out = {d.role: d for d in self.descriptors}, []
        for role in ARRANGEMENTS[form]:
            mark = memoryview(SENTINELS[role])
            out += [Descriptor(mark, 0, len(mark), "sentinel"), by_role[role]]
        return PieceTable(out)

    def restored(self) -> PieceTable:
        """The inverse: without sentinels, in the order of the text."""
        by_role = {d.role: d for d in self.descriptors}
        return PieceTable([by_role[role] for role in PIECES])

    def digest(self) -> str:
        out = hashlib.sha256()
        for d in self.descriptors:
            out.update(d.bytes())
        return out.hexdigest()

    def join(self) -> bytes:
        return b"".join(d.bytes() for d in self.descriptors)


def read_output(output: bytes, form: str) -> PieceTable:
    """Piece table of the text that an output of this form stands for, as descriptors over the output.

    A text that is not plain holds no sentinel, so each occurs once.
    """
    table = PieceTable.of(memoryview(output))
    if form == "plain":
        return table
    places, roles = [], []
    for role in ARRANGEMENTS[form]:
        at = output.index(SENTINELS[role])
        places += [at, at + len(SENTINELS[role])]
        roles += ["sentinel", role]
    # Nothing stands before the first sentinel.
    return PieceTable(table.cut(places).descriptors[1:]).named(tuple(roles)).restored()


def unit_starts(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Byte position of every unit of all texts, and the first unit of each text (one more at the end)."""
    data = texts.data
    letter = _LETTER[data]
    inside = np.zeros(len(data), bool)
    inside[1:] = letter[1:] & letter[:-1]
    edges = texts.offsets[:-1]
    inside[edges[edges < len(data)]] = False
    starts = np.flatnonzero(_LEAD[data] & ~inside)
    return starts, np.searchsorted(starts, texts.offsets)


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    """Four numbers that depend on the id alone; a null id counts as an empty one."""
    digest = hashlib.sha256(f"{SEED}{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * k:4 * k + 4], "big") for k in range(4))


def _rows(ids: list, texts: Texts, with_output: bool) -> Iterator[tuple]:
    starts, first = unit_starts(texts)
    units = np.diff(first)
    # Ends of units: the start of the next one, or the end of the text.
    lead = np.concatenate(([0], np.cumsum(_LEAD[texts.data])))
    body = memoryview(np.ascontiguousarray(texts.data)).cast("B")
    for i in range(texts.count):
        low, high, n = int(texts.offsets[i]), int(texts.offsets[i + 1]), int(units[i])
        text = body[low:high]
        one, two, three, four = draws(ids[i])
        table, form, lengths = PieceTable.of(text), "plain", (None, None)
        if n and three % 100 < PLAIN_FROM:
            raw = bytes(text)
            if not any(mark in raw for mark in SENTINELS.values()):
                form = "spm" if four % 100 < SPM_BELOW else "psm"
                at = [high if k == n else int(starts[first[i] + k]) for k in sorted((one % (n + 1), two % (n + 1)))]
                lengths = int(lead[at[0]] - lead[low]), int(lead[at[1]] - lead[at[0]])
                table = table.cut([p - low for p in at]).named(PIECES).arranged(form)
        output = table.join()
        yield (ids[i], n, form, *lengths, output.decode("utf-8", "replace") if with_output else None,
               table.digest(), read_output(output, form).digest())


def transformed(docs: DataFrame, with_output: bool = True) -> DataFrame:
    """Every document in fill-in-middle form.

    ``docs`` has doc_id and text; other columns are ignored. Returns one row per row, in no
    order: doc_id, n (units), form (plain, psm, spm), prefix_chars and middle_chars (code
    points, null if plain), output (null unless ``with_output``), output_sha256 and
    restored_sha256 (of the text read back from output and form; equals the text's own).

    Cuts and form depend on id and text alone, so repeated rows and rows that share an id and
    text come out alike. A null text counts as empty, an empty text and one that holds a
    sentinel stay plain. A null id draws as an empty one. A text of any length takes about
    three times its bytes beside its batch. Without rows the result is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch["text"]):
                ids = batch["doc_id"].slice(texts.first, texts.count).to_pylist()
                columns = list(zip(*_rows(ids, texts, with_output)))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, OUTPUT_DDL)


def restored(outputs: DataFrame) -> DataFrame:
    """Texts of transformed documents, from doc_id, form and output: doc_id, text.

    A null output has a null text; other columns are ignored, repeated rows stay, without rows
    the result is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch["output"].to_pylist(), batch["form"].to_pylist(), strict=True)
            texts = [None if o is None else read_output(o.encode(), form).join().decode() for o, form in pairs]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = outputs.select(F.col("doc_id").cast("long").alias("doc_id"), "form", "output")
    return rows.mapInArrow(run, "doc_id long, text string")
