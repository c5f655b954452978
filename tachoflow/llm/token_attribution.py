"""Token counts of the sections of a document, from one encoding of the whole text.

The whole text is encoded once; the lengths of the tokens' bytes give each token's span.
Token spans and section spans, both in order, are joined by binary search. A token that
reaches over a section's border goes whole to one section, by one of two rules:

* ``start``: to the section that holds its first byte;
* ``majority``: to the section that holds most of its bytes, the earlier one on a tie.

So the counts of all sections and of the space outside them add up to the tokens of the text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tachoflow.llm.words import slices

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's texts are cut into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OUTSIDE = -1


class Tokens:
    def __init__(self, ranks: str) -> None:
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.coding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=known, special_tokens={})
        self.length = np.zeros(max(known.values()) + 1, np.int64)
        for piece, rank in known.items():
            self.length[rank] = len(piece)

    def ends(self, text: str) -> np.ndarray:
        """End of every token of the text, in bytes."""
        return np.cumsum(self.length[self.coding.encode_ordinary(text)])


def line_starts(data: np.ndarray) -> np.ndarray:
    """Start of every line of a text; a line ends after its line end."""
    return np.concatenate(([0], np.flatnonzero(data[:-1] == 10) + 1)) if len(data) else np.zeros(1, np.int64)


def attribute(token_ends: np.ndarray, start: np.ndarray, end: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token (OUTSIDE: none) and whether it crosses a border.

    Sections are ordered by start. Where they overlap, a byte belongs to the one that starts
    last (the later of equal starts).
    """
    token_start = np.concatenate(([0], token_ends[:-1])) if len(token_ends) else token_ends
    # Borders cut the text into stretches of one owner each.
    cuts = np.unique(np.concatenate(([0], start, end, token_ends[-1:])))
    at = np.searchsorted(start, cuts, "right") - 1
    owner = np.where((at >= 0) & (cuts < end[np.maximum(at, 0)]) if len(start) else False, at, OUTSIDE)
    for k in np.flatnonzero((owner == OUTSIDE) & (at >= 0)).tolist():
        # An earlier, longer section may still cover this stretch.
        cover = np.flatnonzero((start[:at[k]] <= cuts[k]) & (end[:at[k]] > cuts[k]))
        owner[k] = cover[-1] if len(cover) else OUTSIDE
    first = np.searchsorted(cuts, token_start, "right") - 1
    last = np.searchsorted(cuts, token_ends, "left") - 1
    out = owner[first] if len(token_ends) else np.zeros(0, np.int64)
    crossing = np.zeros(len(token_ends), bool)
    for k in np.flatnonzero(last > first).tolist():
        stretch = np.arange(first[k], last[k] + 1)
        size = np.minimum(np.append(cuts, token_ends[-1])[stretch + 1], token_ends[k]) - np.maximum(cuts[stretch], token_start[k])
        names, share = owner[stretch], {}
        for name, n in zip(names.tolist(), size.tolist(), strict=True):
            share[name] = share.get(name, 0) + n
        crossing[k] = len(share) > 1
        if rule == "majority":
            out[k] = max(share, key=share.get)
    return out, crossing


def section_token_counts(docs: DataFrame, sections: str | None = None, rule: str = "start", ranks: str = RANKS) -> DataFrame:
    """Tokens of every section of every text.

    ``docs`` has doc_id and text and, if ``sections`` names it, a column of sections
    array<struct<start, end>> in characters (end exclusive); without it the lines are the
    sections. Other columns are ignored. Returns a row per section: doc_id, section (its
    place, from 0, ordered by start), n_bytes, n_tokens and n_crossing (tokens counted here
    that reach over a border), and a row with section -1 where tokens lie outside all, with the
    bytes that no section holds.

    A null text has one row with a null section and no tokens; an empty text has one empty
    line. Null sections are none; spans are cut to the text, null ends and empty spans stay
    with 0 tokens. Repeated rows give repeated counts, equal sections share their tokens by
    place (the last one has them). Texts of any length are encoded whole. No rows give no rows.
    """
    if rule not in ("start", "majority"):
        raise ValueError("rule is start or majority")
    spans = F.transform(sections, lambda s: F.struct(s["start"].cast("long").alias("start"), s["end"].cast("long").alias("end"))) if sections else F.lit(None).cast("array<struct<start:bigint,end:bigint>>")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), spans.alias("spans"))
    by_line = sections is None

    def of_text(tokens: Tokens, text: str, spans: list | None) -> tuple[np.ndarray, ...]:
        data = np.frombuffer(text.encode(), np.uint8)
        if by_line:
            start = line_starts(data)
            end = np.append(start[1:], len(data))
        else:
            letter = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
            chosen = sorted((min(max(s["start"] or 0, 0), len(text)), min(max(s["end"] or 0, 0), len(text))) for s in spans or [] if s is not None)
            start = letter[np.array([a for a, _ in chosen], np.int64)]
            end = np.maximum(letter[np.array([b for _, b in chosen], np.int64)], start)
        ends = tokens.ends(text)
        owner, crossing = attribute(ends, start, end, rule)
        n = len(start)
        counts = np.bincount(owner + 1, minlength=n + 1)
        crossed = np.bincount(owner[crossing] + 1, minlength=n + 1)
        # Bytes in no section: sections may overlap, so each counts from where those before it end.
        before = np.maximum.accumulate(np.append(0, end))[:-1]
        size = np.append(len(data) - np.maximum(end - np.maximum(start, before), 0).sum(), end - start)
        keep = np.append(counts[0] > 0, np.ones(n, bool))
        return np.arange(-1, n)[keep], size[keep], counts[keep], crossed[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = None
        for batch in batches:
            tokens = tokens or Tokens(ranks)
            for part in slices(batch["text"]):
                keys, rows = [], []
                ids = batch["doc_id"].slice(part.first, part.count)
                texts = batch["text"].slice(part.first, part.count).to_pylist()
                spans = batch["spans"].slice(part.first, part.count).to_pylist()
                nothing = []
                for k, text in enumerate(texts):
                    if text is None:
                        nothing.append(k)
                        continue
                    found = of_text(tokens, text, spans[k])
                    keys.append(np.full(len(found[0]), k))
                    rows.append(found)
                columns = [np.concatenate(x).astype(np.int64) for x in zip(*rows, strict=True)] if rows else [np.zeros(0, np.int64)] * 4
                key = np.concatenate([*keys, np.array(nothing, np.int64)]) if keys or nothing else np.zeros(0, np.int64)
                pad = np.zeros(len(nothing), np.int64)
                full = [pa.array(np.append(c, pad)) for c in columns]
                full[0] = pa.array(np.append(columns[0], pad), mask=np.arange(len(key)) >= len(key) - len(nothing))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(key)), *full], ["doc_id", "section", "n_bytes", "n_tokens", "n_crossing"])

    return docs.mapInArrow(run, "doc_id long, section long, n_bytes long, n_tokens long, n_crossing long")
