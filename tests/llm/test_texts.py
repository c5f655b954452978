"""Operators that look at one text after the other."""


import random
import re

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tachoflow.llm import kneser_ney as kn
from tachoflow.llm.boosting import Row, boost, sigmoid
from tachoflow.llm.decontamination import contaminated, exact_shingles, folded
from tachoflow.llm.personal_data import joined, personal_data, redacted
from tachoflow.llm.quality_rules import quality_report
from tachoflow.llm.words import find_words, hash_words, mix, slices

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def luhn(digits):
    each = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in each) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": all(int(p) < 256 for p in m.group().split(".")) if kind == "ip" else False,
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


CASES = [
    "write to a.b@c.de_x@y.org now", "x@y", "@@a@b.c@d.e", "1.2.3.4.5.6.7.8 and 999.1.1.1 10.0.0.255", "00000000000000000001.2.3.4", "99999999999999999999.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111", "+1 (269) 555-3296 4532015112830366 x", "5 4111111111111111 7", "1 2  4111 1111 1111 1111",
    "call +49 30 1234567. or +1", "🎉 +1 (555) 123-4567 🎉 é a@b.cc", "12" * 4000, "a" * 9000 + "@b.c", "+" + "1 " * 3000, "phone 555-123-4567", "me [at] host [dot] org", "",
]


def test_base_spans(spark, edge_docs, edge_rows, no_docs):
    table = [(k, t) for k, t in enumerate(CASES * 2)]
    found = personal_data(spark.createDataFrame(table, "doc_id long, text string"))
    got = {r.doc_id: r for r in found.select("doc_id", joined("base").alias("base"), joined("spans").alias("spans")).collect()}
    for k, text in table:
        assert got[k].base == ",".join(base_spans(text)), text
        spans = [s for s in got[k].spans.split(",") if s]
        assert set(base_spans(text)) <= set(spans)
        assert all(int(s.split(":")[1]) < int(s.split(":")[2]) <= len(text) for s in spans)
    split = got[CASES.index("+1 (269) 555-3296 4532015112830366 x")].spans
    assert "card:18:34" in split and "phone:0:17" in split
    assert [r[0] for r in rows(personal_data(edge_docs).select("doc_id"))] == sorted((r[0] for r in edge_rows), key=lambda x: str((x,)))
    assert personal_data(no_docs).count() == 0


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "é a@b.cc, 10.0.0.1"), (2, None), (3, "none"), (1, "other x@y.zz"), (None, "q@r.ss")], "doc_id long, text string")
    got = rows(redacted(docs, personal_data(docs)))
    assert got == sorted([(1, "é [EMAIL], [IP]"), (2, None), (3, "none"), (1, "other [EMAIL]"), (None, "[EMAIL]")], key=str)


def test_boosted_trees_learn_a_rule():
    table = [Row((a, b, c), 90.0 * (a and b), 100 - 90.0 * (a and b)) for a in (0, 1) for b in (0, 1) for c in (0, 1, 2)]
    bias, trees = boost(table, (2, 2, 3))
    for r in table:
        assert (sigmoid(bias + sum(t.score(r.features) for t in trees)) > 0.5) == bool(r.features[0] and r.features[1])


def quality_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def test_quality_rules(edge_docs, edge_rows, no_docs, spark):
    got = quality_report(edge_docs).collect()
    assert sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got], key=str) == sorted(
        [(r[0], *quality_counts(r[1])) for r in edge_rows], key=str)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
        assert (r.log_perplexity is None) == (r.doc_id in (4, 5))
    assert quality_report(no_docs).count() == 0
    odd = [(k, "a#b|c a#b|c\n\nx y z w\nx y z w\r\n a a a a", None) for k in range(3)]
    got = quality_report(spark.createDataFrame(odd, "doc_id long, text string, lang string")).first()
    assert tuple(got)[1:6] == quality_counts(odd[0][1])


def test_perplexity_band_rejects_noise(spark):
    from tests.llm.conftest import words

    rng = np.random.default_rng(1)
    clean = [(k, words(k, 90), "en") for k in range(60)]
    noise = [(100, "".join(chr(c) for c in rng.integers(33, 126, 900)) + " q" * 3 + " ".join("zqxjkvbw"[i % 8] + str(i) for i in range(60)), "en")]
    kept = {r.doc_id: r.kept for r in quality_report(spark.createDataFrame(clean + noise, "doc_id long, text string, lang string")).collect()}
    assert all(kept[k] for k in range(60)) and not kept[100]


KN_TEXTS = ["the cat sat on the mat. " * 3, "ünïcode, 日本 🎉 ok?", "", "that hat", "\n\na"]


def kneser_ney(texts):
    """p(last | first two) by counting strings, with the same discounts and trace."""
    def symbol(c):
        return ord(c) if ord(c) < kn.OWN else kn.OWN + int(mix(np.array([ord(c)], np.uint64))[0]) % kn.OWN

    grams = Counter()
    for text in texts:
        s = [10, 10, *map(symbol, text)]
        grams.update(tuple(s[k:k + 3]) for k in range(len(s) - 2))
    counts = {3: grams}
    for n in (2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])

    def law(gram):
        if not gram:
            return 1 / (2 * kn.OWN)
        own = counts[len(gram)]
        d = kn.discounts(np.array(list(own.values())))
        same = {g: c for g, c in own.items() if g[:-1] == gram[:-1]}
        if not same:
            return law(gram[1:])
        total = sum(same.values())
        left = kn.TRACE + (1 - kn.TRACE) * sum(d[min(c, 3)] for c in same.values()) / total
        c = own.get(gram, 0)
        return (1 - kn.TRACE) * (c - d[min(c, 3)] if c else 0) / total + left * law(gram[1:])

    return grams, law


def test_kneser_ney_equals_counted_strings():
    texts = next(slices(pa.array(KN_TEXTS)))
    codes, first = kn.trigrams(texts.data, texts.offsets)
    assert np.diff(first).tolist() == [len(t) for t in KN_TEXTS]
    model = kn.fit(*np.unique(codes, return_counts=True))
    grams, law = kneser_ney(KN_TEXTS)
    coded = [a << 24 | b << 12 | c for a, b, c in grams]
    assert sorted(coded) == np.unique(codes).tolist()
    asked = [*grams, (1, 2, 3), (ord("t"), ord("h"), 5), (5, ord("h"), ord("e")), (10, 10, 99), (7, 7, ord("a"))]
    got = np.exp(kn.log_probabilities(model, np.array([a << 24 | b << 12 | c for a, b, c in asked])))
    assert np.allclose(got, [law(g) for g in asked], rtol=1e-9)
    for context in ((ord("t"), ord("h")), (ord("q"), ord("t")), (1, 1)):
        every = (context[0] << 24 | context[1] << 12) + np.arange(1 << 12)
        assert np.exp(kn.log_probabilities(model, every)).sum() == pytest.approx(1)
    assert np.allclose(kn.log_probabilities(kn.UNIFORM, np.array([1, 2])), -np.log(4096))


def test_bands_find_junk_alike_in_pieces(spark):
    """Symbol junk, another language and changed word forms, among more clean texts of two languages."""
    from tests.llm.conftest import words

    rng = random.Random(5)
    other = lambda k: " ".join("".join(rng.choice(("lo", "mi", "ka", "zu", "vo")) for _ in range(3)) for _ in range(150))
    docs = [(k, words(k, 150), "en") for k in range(120)] + [(1000 + k, other(k), "xx") for k in range(60)]
    docs += [(500 + k, words(600 + k, 150).replace(" ", "&& "), "en") for k in range(12)]
    docs += [(2000 + k, other(k), "en") for k in range(5)] + [(3000 + k, words(k, 150), "xx") for k in range(5)]
    docs += [(4000 + k, words(700 + k, 150), None) for k in range(30)]
    rows = quality_report(spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)).collect()
    kept = {r.doc_id: r.kept for r in rows}
    assert not any(r.base_failed for r in rows)
    share = lambda low, high: sum(kept[i] for i in kept if low <= i < high) / sum(low <= i < high for i in kept)
    assert share(0, 500) > 0.97 and share(1000, 2000) > 0.95 and share(4000, 5000) > 0.9
    assert share(500, 600) == share(2000, 3000) == share(3000, 4000) == 0
    # Without the other language its verdicts stay as they were.
    again = quality_report(spark.createDataFrame([d for d in docs if d[2] == "en"], "doc_id long, text string, lang string")).collect()
    assert all(r.kept == kept[r.doc_id] for r in again)


def test_decontamination(spark, edge_docs, no_docs):
    from tests.llm.conftest import words

    passage = words(77, 30)
    items = [(1, passage), (2, "only three words"), (3, None), (4, ""), (5, passage), (1, passage), (6, words(78, 40))]
    texts = [words(k, 300) for k in range(6)]
    cut = passage.split()
    cut[15] = "other"
    texts += [texts[0] + " " + passage.upper() + ". " + texts[1], passage.replace(" ", ", "), "x only, three WORDS y", " ".join(cut), words(1, 4000) + " " + words(78, 40)[10:] + " end", None, ""]
    docs = [(k, t) for k, t in enumerate(texts)]
    expected = []
    for k, t in docs:
        for item, text in {(i, x) for i, x in items if x}:
            need = folded(text).split()
            size = min(5, len(need))
            held = set(zip(*(folded(t).split()[j:] for j in range(size))))
            wanted = set(zip(*(need[j:] for j in range(size))))
            if 100 * len(held & wanted) >= 80 * len(wanted):
                expected.append((k, item, len(wanted), len(held & wanted)))
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id")
    assert rows(contaminated(spark.createDataFrame(docs, "doc_id long, text string"), benchmark)) == sorted(expected, key=str)
    assert {r[0] for r in expected} >= {6, 7, 8}
    assert contaminated(no_docs, benchmark).count() == 0
    assert contaminated(edge_docs, benchmark.where("false")).count() == 0
    assert exact_shingles(b"a b", 5) == {b"a b"}


def test_words_are_the_bytes_between_white_space():
    import pyarrow as pa

    texts = ["a  b\tc", None, "", "\n", "é\x0bü 🎉\xa0x", "end"]
    for part in slices(pa.array(texts), 8):
        found = find_words(part)
        data = part.data.tobytes()
        for k in range(part.count):
            got = [data[s:e] for s, e, t in zip(found.start, found.end, found.text, strict=True) if t == k]
            assert got == (texts[part.first + k] or "").encode().split()
    one = next(slices(pa.array(["ab ba ab aab"])))
    hashes = hash_words(one.data, find_words(one))
    assert hashes[0] == hashes[2] and len(set(hashes.tolist())) == 3


@pytest.mark.parametrize("percent", [0, 101])
def test_percent_is_checked(percent):
    from tachoflow.llm.partenum import Bands

    with pytest.raises(ValueError):
        Bands(percent)
