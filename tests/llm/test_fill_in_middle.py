import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tachoflow.llm.fill_in_middle import PieceTable, read_output, restored, transformed

DOCS = "doc_id long, text string"


def _plain(doc_id, text):
    """The transformation by whole strings."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    spm = h[3] % 100 < 20
    return doc_id, n, "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def _sorted(rows):
    return sorted(rows, key=repr)


def test_equals_whole_strings(spark, edge_rows):
    texts = ["", None, "a", "<", "<P>x", "x <S", "S>y", "<M", "two words", "Ünï 🎉<P", "\x00\n", "aB9c" * 50, "🎉" * 9]
    rows = [(i, t) for i in [*range(40), None] for t in texts] + [(r[0], r[1]) for r in edge_rows]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as n", "'x' as form", "2 as output").repartition(3)
    got = transformed(df)
    seen = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got.collect()]
    expected = [_plain(*r) for r in rows]
    assert _sorted(seen) == _sorted(expected)
    assert {r[2] for r in seen} == {"plain", "psm", "spm"}
    for r, (i, t) in zip(sorted(got.collect(), key=lambda r: (repr(r.doc_id), r.output_sha256)),
                         sorted(((r[0], r[5]) for r in expected), key=lambda r: (repr(r[0]), hashlib.sha256(r[1].encode()).hexdigest()))):
        assert r.output_sha256 == hashlib.sha256(t.encode()).hexdigest()
    back = restored(got.withColumn("text", got.output))
    assert _sorted(tuple(r) for r in back.collect()) == _sorted((i, t or "") for i, t in rows)


def test_digest_of_the_restored_text(spark, edge_docs, edge_rows):
    got = sorted((repr(r.doc_id), r.restored_sha256) for r in transformed(edge_docs, with_output=False).collect())
    assert got == sorted((repr(r[0]), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in edge_rows)


def test_very_long_text(spark):
    text = "word, " * 700_000 + "end 🎉"
    row = transformed(spark.createDataFrame([(5, text)], DOCS)).first()
    assert (row.doc_id, row.n, row.form, row.prefix_chars, row.middle_chars, row.output) == _plain(5, text)


def test_empty_tables(spark, no_docs):
    assert transformed(no_docs).collect() == []
    assert restored(transformed(no_docs)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB<>PSM é\n", max_size=30), st.lists(st.integers(0, 30), min_size=2, max_size=2), st.sampled_from(["psm", "spm"]))
def test_read_output_inverts_every_arrangement(text, places, form):
    if any(mark in text for mark in ("<P>", "<S>", "<M>")):
        return
    body = text.encode()
    cuts = sorted(min(p, len(body)) for p in places)
    table = PieceTable.of(memoryview(body)).cut(cuts)
    assert table.join() == body and len(table.descriptors) == 3
    output = table.named(("prefix", "middle", "suffix")).arranged(form)
    assert read_output(output.join(), form).join() == body
    assert output.digest() == hashlib.sha256(output.join()).hexdigest()


def test_pieces_share_the_text():
    text = memoryview(b"one two three")
    cut = PieceTable.of(text).cut([0, 4]).cut([2, 4, 8])
    assert [bytes(d.bytes()) for d in cut.descriptors] == [b"", b"on", b"e ", b"", b"two ", b"three"]
    assert all(d.buffer is text for d in cut.descriptors)
    with pytest.raises(ValueError):
        read_output(b"no sentinel", "psm")
