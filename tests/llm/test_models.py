"""Quotation linking, language model, classifier, pieces, token counts, pages and the pipeline."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import sentencepiece

import corpus_pipeline
from tachoflow.llm import context_mixing as cm
from tachoflow.llm.dom import read
from tachoflow.llm.html_extraction import MAIN, Model, features, main_text, never, page_tree
from tachoflow.llm.lm_scoring import scored
from tachoflow.llm.pieces import Encoder, Vocabulary, suffix_array
from tachoflow.llm.quotation_linking import reply_threads
from tachoflow.llm.sentencepiece_codec import MODEL, decoded, encoded
from tachoflow.llm.token_attribution import RANKS, Tokens, attribute, section_token_counts
from tachoflow.llm.weak_labels import expectation_maximisation, quality_scores
from tachoflow.llm.words import slices
from tests.llm.conftest import DOCS, words


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_quotation_linking(spark):
    talk = [
        (1, 0, "u", "Hello there.\nHow are you?"), (1, 1, "a", "On Monday, u wrote:\n> Hello  there.\n> How are you?\n\nFine!\nAnd you?"),
        (1, 2, "u", "> Fine!\n> > hello there.\n\nGood."), (1, 3, "u", "> How are YOU?\nnew branch"), (1, 4, "u", ">> x\n> nothing known\nyes"),
        (1, 5, "a", None), (None, 1, "a", "> Fine!"), (2, 0, "u", "> Hello there.\n"), (1, 6, "z", "> Good.\r\n> extra line\r\nok"),
        (1, 2, "u", "> Fine!\n> > hello there.\n\nGood."), (1, None, "u", "> Good."), (3, 0, "u", ""), (1, 7, None, "> " * 3000 + "deep"),
    ]
    found = reply_threads(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as level", "2 as hash", "3 as quotes"))
    got = rows(found.select("conv_id", "turn", "parent_turn", "thread_turn", "reply_depth", "own_text", "n_quotes", "n_linked"))
    assert got == sorted([
        (1, 0, None, 0, 0, "Hello there.\nHow are you?", 0, 0), (1, 1, 0, 0, 1, "Fine!\nAnd you?", 1, 1), (1, 2, 1, 0, 2, "Good.", 2, 2), (1, 2, 1, 0, 2, "Good.", 2, 2),
        (1, 3, 0, 0, 1, "new branch", 1, 1), (1, 4, None, 4, 0, "yes", 2, 0), (1, 5, None, 5, 0, "", 0, 0), (1, 6, 2, 0, 3, "ok", 1, 1), (None, 1, None, 1, 0, "", 1, 0),
        (2, 0, None, 0, 0, "", 1, 0), (1, None, None, None, 0, "", 1, 0), (3, 0, None, 0, 0, "", 0, 0), (1, 7, None, 7, 0, "", 1, 0),
    ], key=str)
    assert reply_threads(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_long_reply_chain(spark):
    talk = [(1, k, "u", f"> said {k - 1}\nsaid {k}") for k in range(40)]
    got = {r.turn: r for r in reply_threads(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")).collect()}
    assert all(got[k].thread_turn == 0 and got[k].reply_depth == k for k in range(40))


def base_scores(docs):
    known, out = Counter(), {}
    for i, t in docs:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            known.update([*(t or "").encode().lower().split(), None])
    total, distinct = sum(known.values()), len(known)
    for i, t in docs:
        tokens = [*(t or "").encode().lower().split(), None]
        out[i, t] = (len(tokens), sum(known[w] > 0 for w in tokens), total, sum(math.log10((known[w] + 1) / (total + distinct + 1)) for w in tokens))
    return out


def test_language_model(spark, edge_docs, edge_rows, no_docs):
    docs = [(r[0], r[1]) for r in edge_rows] + [(100 + k, words(k % 7, 150)) for k in range(60)]
    table = edge_docs.select("doc_id", "text").unionByName(spark.createDataFrame(docs[len(edge_rows):], "doc_id long, text string"))
    expected = base_scores(docs)
    found = scored(table).join(table.distinct(), "doc_id").collect()
    for r in found:
        n, known, total, base = expected[r.doc_id, r.text]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    assert len(scored(table).collect()) == len(docs)
    held = [r for r in found if r.held_out and r.doc_id >= 100]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert scored(no_docs).count() == 0


def test_codes_can_be_read_back_and_probabilities_sum_to_one():
    code = cm.huffman([5, 1, 0, 9, 2])
    texts = {tuple(code.bit[code.offset[s]:code.offset[s + 1]]) for s in range(5)}
    assert len(texts) == 5 and not any(a != b and b[:len(a)] == a for a in texts for b in texts)
    assert math.isclose(sum(2.0 ** -len(t) for t in texts), 1)
    lexicon = cm.lexicon(np.array([7, 9], np.uint64), np.array([5, 4]), 3, 2, [1] * 256)
    part = next(slices(pa.array(["some words zz"])))
    texts_, tokens = cm.tokenise(part, lexicon)
    bits = cm.bits_of(texts_, tokens, lexicon)
    none = cm.Counts(np.zeros(cm.INPUTS * cm.SLOTS, np.float16), np.zeros(cm.INPUTS * cm.SLOTS, np.uint8))
    score, _ = cm.mixed(bits, 1, none, cm.first_weights(), rate=0)
    # Without counts every bit has even odds.
    assert math.isclose(score[0], -len(bits.bit) * math.log(2), rel_tol=1e-5)


def test_slots_equal_a_plain_hash():
    """The slot of every bit, from its node and context one at a time."""
    code, most = cm.huffman([5, 1, 0, 9, 2]), (1 << 64) - 1
    symbol = np.array([3, 2, 2, 0, 4, 1])
    context = np.arange(6, dtype=np.uint64) * np.uint64(0xABCDEF123456789)
    sizes, entry = cm._spread(code.offset, symbol)
    assert entry.tolist() == [k for s in symbol for k in range(code.offset[s], code.offset[s + 1])]
    assert code.step[entry].tolist() == [k for s in symbol for k in range(code.offset[s + 1] - code.offset[s])]
    for salt in (0, 2, 9):
        plain = [
            (((int(cm.mix(c + np.uint64(salt << 32))) + int(code.node[k]) * 0x9E3779B97F4A7C15) * 0xD6E8FEB86659FD93 & most) >> 64 - cm.SLOT_BITS) + (salt & 7) * cm.SLOTS
            for c, s in zip(context, symbol, strict=True) for k in range(code.offset[s], code.offset[s + 1])]
        assert cm._slot(code.spread[entry], context, sizes, salt).tolist() == plain
    none = cm._slot(code.spread[entry], np.zeros(6, np.uint64), sizes, 0)
    assert cm._slot(code.spread[entry], None, sizes, 0).tolist() == none.tolist()


def _plain_slots(texts, lexicon):
    """(bit, slot of each input) of every bit, from the words of each text one at a time."""
    most, out = (1 << 64) - 1, []
    mix = lambda x: int(cm.mix(np.array([x & most], np.uint64))[0])
    rank = {int(h): int(r) for h, r in zip(lexicon.hashes, lexicon.rank, strict=True)}

    def spread(code, symbol, contexts, salt):
        for k in range(code.offset[symbol], code.offset[symbol + 1]):
            node = int(code.node[k]) * 0x9E3779B97F4A7C15
            slots = [((mix(c + (salt + j << 32)) + node) * 0xD6E8FEB86659FD93 & most) >> 64 - cm.SLOT_BITS for j, c in enumerate(contexts)]
            out.append((int(code.bit[k]), *(s + j * cm.SLOTS for j, s in enumerate(slots))))

    for text in texts:
        last, topic = int(cm._START), 0
        for word in [*(text or "").encode().lower().split(), None]:
            value = int(cm._END_VALUE) if word is None else int(cm.tokenise(next(slices(pa.array([word.decode()]))), None)[1].value[0])
            symbol = cm.END if word is None else rank.get(value, cm.ESCAPE - cm.FIRST_WORD) + cm.FIRST_WORD
            spread(lexicon.words, symbol, (0, last, topic), 0)
            if symbol == cm.ESCAPE:
                past, prefix = [0, 0, 0, 0], 0
                for k, letter in enumerate([*word, cm.CLOSE]):
                    two, four = past[0] * 257 + past[1], ((past[0] * 257 + past[1]) * 257 + past[2]) * 257 + past[3]
                    spread(lexicon.bytes, letter, (two + mix(topic), four, prefix), 8)
                    past, prefix = [letter + 1, *past[:3]], prefix + mix((letter + 1) * 1000 + k) & most
            last, topic = value, symbol if cm.FIRST_WORD <= symbol < cm.FIRST_WORD + cm.COMMON else topic
    return out


def test_alike_words_are_spread_once_and_every_bit_is_counted(monkeypatch):
    """Counts of all slots equal those of a plain loop, however texts are held; the work grows with pairs that differ."""
    texts = [words(k % 3, 9) for k in range(6)] + ["", None, "zz the", "the of zz\tabcdefgh", "É the É", words(1, 9) + " qq " + words(2, 9)]
    some = next(slices(pa.array([words(1, 9)])))
    value = np.unique(cm.tokenise(some, None)[1].value[:9])[::2]
    lexicon = cm.lexicon(value, np.arange(len(value), 0, -1), 5, 4, list(range(256)))
    plain, expected = _plain_slots(texts, lexicon), np.zeros((2, cm.INPUTS * cm.SLOTS), np.int64)
    for bit, *slot in plain:
        expected[bit, slot] += 1
    parts = [(cm.tokenise(part, lexicon)) for k in range(0, len(texts), 4) for part in slices(pa.array(texts[k:k + 4], pa.string()))]
    for held in (1, 40, cm.HELD):
        monkeypatch.setattr(cm, "HELD", held)
        monkeypatch.setattr(cm, "PIECE", held)
        tally = cm.Tally(lexicon)
        for part in parts:
            tally.add(*part)
        assert (tally.close() == expected).all()
    bits = cm.bits_of(*cm.tokenise(next(slices(pa.array(texts))), lexicon), lexicon)
    slot = [np.concatenate([g.plain[g.slot[k]] if g.plain is not None and not k else g.slot[k] for g in (bits.words, bits.letters)]) + k * cm.SLOTS for k in range(cm.INPUTS)]
    assert sorted(plain) == sorted(zip(bits.bit.tolist(), *(x.tolist() for x in slot), strict=True))
    # A text that comes 200 times is not spread 200 times.
    spread, place = [], cm._place
    monkeypatch.setattr(cm, "_place", lambda *a: spread.append(len(a[0])) or place(*a))
    known = cm.tokenise(next(slices(pa.array([words(1, 9)]))), None)[1]
    lexicon = cm.lexicon(np.unique(known.value[:9]), np.arange(len(np.unique(known.value[:9])), 0, -1), 5, 4, list(range(256)))
    for times in (1, 200):
        tally = cm.Tally(lexicon)
        for part in slices(pa.array([words(1, 9)] * times)):
            tally.add(*cm.tokenise(part, lexicon))
        spread.append(-tally.close().sum())
    met = [-x for x in spread if x < 0]
    at = spread.index(-met[0])
    assert met[1] == 200 * met[0] and sum(spread[at + 1:-1]) <= sum(spread[:at])


def test_commonest_words_are_found_among_like_hashes():
    """Words that share the first bits of their hashes, below and above them, and none at all."""
    rng = np.random.default_rng(8)
    hashes = np.unique(np.concatenate([rng.integers(0, 1 << 63, 500).astype(np.uint64), np.arange(90, 99, dtype=np.uint64), np.array([(1 << 64) - 1, 1 << 63], np.uint64)]))
    lexicon = cm.lexicon(hashes, np.arange(len(hashes), 0, -1), 5, 4, [1] * 256)
    asked = np.concatenate([hashes, hashes - np.uint64(1), hashes + np.uint64(1)])
    expected = {int(h): k for k, h in enumerate(hashes)}
    assert lexicon.place(asked).tolist() == [expected.get(int(h), -1) for h in asked]
    assert cm.lexicon(hashes[:0], np.zeros(0), 5, 4, [1] * 256).place(asked).tolist() == [-1] * len(asked)


def test_first_weights_come_from_all_training_texts(spark):
    """Every bit of more texts than any sample took counts, however the rows are dealt; the fit is the most likely one."""
    from tachoflow.llm import lm_scoring

    texts = [words(k % 500, 5 + k % 7) for k in range(2500)] + ["", None]
    lexicon = cm.lexicon(np.array([7, 9], np.uint64), np.array([5, 4]), 3, 2, list(range(256)))
    bits = [cm.bits_of(*cm.tokenise(part, lexicon), lexicon) for part in slices(pa.array(texts))]
    rng = np.random.default_rng(3)
    met = rng.integers(0, 4, cm.INPUTS * cm.SLOTS)
    ones = rng.integers(0, met + 1)
    table = cm.Counts(cm.log_odds(met - ones, ones).astype(np.float16), met.astype(np.uint8))
    expected = Counter(np.concatenate([cm.cells_of(b, cm.rounded_inputs(table)) for b in bits]).tolist())
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    shared, rounded = (spark.sparkContext.broadcast(x) for x in (tuple(lexicon), cm.rounded_inputs(table)))
    for parts in (1, 5):
        got = lm_scoring._cell_counts(docs.repartition(parts), shared, rounded).collect()
        assert {r.cell: r.n for r in got} == expected
    assert sum(expected.values()) == sum(len(b.bit) for b in bits)
    # At the fitted weights no small step makes the bits of a gate likelier.
    cells, n = (np.array(x) for x in zip(*sorted(expected.items()), strict=True))
    weights = cm.fitted_weights(cells, n).astype(float)
    x = np.stack([(cells // 2 // cm.WIDTH ** k % cm.WIDTH - cm.STEPS) * cm.STEP for k in (2, 1, 0)] + [np.full(len(cells), float(cm.BIAS))], axis=1)
    gate, sign = cells // 2 // cm.WIDTH ** 3, 2 * (cells % 2) - 1
    loss = lambda w: n @ np.logaddexp(0, -sign * (x * w[gate]).sum(axis=1)) + 0.5 * cm.PULL * ((w - cm.first_weights()) ** 2).sum()
    assert len(set(gate)) > 3
    for k in range(cm.INPUTS + 1):
        for step in (-0.01, 0.01):
            moved = weights.copy()
            moved[:, k] += step
            assert loss(moved) > loss(weights)


def test_own_occurrence_is_taken_out():
    table = cm.Counts(cm.log_odds(np.array([0, 2, 1.0]), np.array([1, 1, 0.0])).astype(np.float16), np.array([1, 3, 1], np.uint8))
    left = cm.rounded_inputs(table).reshape(3, 2).astype(int)
    odds = lambda zeros, ones: round(float(cm.log_odds(np.array(zeros), np.array(ones))) / cm.STEP) + cm.STEPS
    assert left[0, 1] == odds(0, 0) and left[2, 0] == odds(0, 0)
    assert left[1].tolist() == [odds(1, 1) + cm.FLAG, odds(2, 0) + cm.FLAG]


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20000) < 0.8
    accuracy = [0.9, 0.8, 0.7, 0.95]
    votes = np.stack([np.where(rng.random(20000) < a, truth, ~truth) for a in accuracy], axis=1).astype(int)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    _, share, given = expectation_maximisation(patterns, counts.astype(float))
    assert abs(share - 0.8) < 0.03
    assert all(abs(given[j, 1, 1] - a) < 0.03 for j, a in enumerate(accuracy))


def test_quality_classifier(spark, edge_docs, edge_rows, no_docs):
    rng = np.random.default_rng(2)
    good = [(k, words(k, 120).capitalize().replace(" th ", ". ") + ".", 1) for k in range(80)]
    bad = [(1000 + k, " ".join(w + "%%%" + "#" * int(rng.integers(1, 4)) for w in words(500 + k, 120).split()), 0) for k in range(40)]
    table = spark.createDataFrame([(i, t) for i, t, _ in good + bad], "doc_id long, text string")
    got = {r.doc_id: r for r in quality_scores(table).collect()}
    assert sum(got[i].keep == bool(q) for i, _, q in good + bad) >= 114
    assert len(quality_scores(edge_docs).collect()) == len(edge_rows)
    assert quality_scores(no_docs).count() == 0


def test_pieces_equal_the_library(spark, edge_docs, edge_rows, no_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = np.random.default_rng(5)
    texts = ["", "a", " ", "   x", "a  ", "  Hi  you\n\ttab é ﬁ Ａ\xa0x　y \x00 z ", "▁x", "日本語のテキスト。" * 60, "aaaa" * 100, "x" * 1000, " " * 70 + "z" + " " * 40, "🎉🎉 ab"]
    texts += ["".join(rng.choice(list("ab  \nthé日eE9."), rng.integers(1, 300))) for _ in range(200)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = encoded(table)
    for r in found.collect():
        assert list(r.ids) == model.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.round_trip == ("▁" not in texts[r.doc_id])
    back = {r.doc_id: r.text for r in decoded(found).collect()}
    assert all(back[k] == t.replace("▁", " ") for k, t in enumerate(texts))
    got = encoded(edge_docs).collect()
    assert len(got) == len(edge_rows) and all((r.ids is None) == (r.doc_id == 4) and r.round_trip in (None, True) for r in got)
    assert encoded(no_docs).count() == 0


def test_few_new_characters_are_indexed():
    """Segments of all kinds and lengths, each learned alone: fewer characters than codes go into a key."""
    library, vocabulary = sentencepiece.SentencePieceProcessor(model_file=MODEL), Vocabulary(MODEL)
    for n in range(1, 25):
        for text in ("a" * n, "ab" * n, "é" * n, " " * n, "the quick"[:n], "0123456789abcdefghijklmn"[:n]):
            assert Encoder(vocabulary).encode([text])[0].tolist() == library.encode(text)
    codes = np.array([2, 1, 1, 2, 1])
    for n in range(1, 6):
        for depth in (1, 3, 16, 40):
            order = suffix_array(codes[:n], depth)
            assert order.tolist() == sorted(range(n), key=lambda k: codes[k:n].tolist())[:n] or depth < n


def brute_attribution(ends, sections, rule):
    owner = lambda b: max(((s, k) for k, (s, e) in enumerate(sections) if s <= b < e), default=(0, -1))[1]
    out, crossing, start = [], [], 0
    for end in ends:
        names = [owner(b) for b in range(start, end)]
        share = Counter(names)
        first = {n: names.index(n) for n in share}
        out.append(names[0] if rule == "start" else min(share, key=lambda n: (-share[n], first[n])))
        crossing.append(len(share) > 1)
        start = end
    return out, crossing


def test_token_attribution():
    rng = np.random.default_rng(4)
    for _ in range(150):
        ends = np.cumsum(rng.integers(1, 6, rng.integers(1, 12)))
        sections = sorted((int(a), int(b)) for a, b in np.sort(rng.integers(0, ends[-1] + 1, (rng.integers(0, 5), 2)), axis=1))
        for rule in ("start", "majority"):
            got = attribute(ends, np.array([s for s, _ in sections], np.int64), np.array([e for _, e in sections], np.int64), rule)
            expected = brute_attribution(ends.tolist(), sections, rule)
            assert (got[0].tolist(), got[1].tolist()) == expected


def test_token_counts(spark, edge_docs, edge_rows, no_docs):
    tokens = Tokens(RANKS)
    for rule in ("start", "majority"):
        got = section_token_counts(edge_docs.where("doc_id <> 2 or doc_id is null"), rule=rule).collect()
        for i, text, *_ in edge_rows:
            mine = [r for r in got if r.doc_id == i]
            if i == 2:
                continue
            assert sum(r.n_tokens for r in mine) == len(tokens.coding.encode_ordinary(text or ""))
            assert len(mine) == (1 if text is None else text.count("\n") + (not text.endswith("\n") or text == ""))
    fields = spark.createDataFrame([(1, "title: naïve body text", [(0, 6), (7, 12), (None, None), (13, 99)]), (2, None, None), (3, "x", None)],
                                   "doc_id long, text string, parts array<struct<start:int,end:int>>")
    got = rows(section_token_counts(fields, "parts").select("doc_id", "section", "n_bytes"))
    # Two blanks lie in no section, and a token begins with each.
    assert got == sorted([(1, -1, 2), (1, 0, 0), (1, 1, 6), (1, 2, 6), (1, 3, 9), (2, None, 0), (3, -1, 1)], key=str)
    far = spark.createDataFrame([(1, "one two three four five", [(4, 7), (4, 7), (5, 6), (2, 5)])], "doc_id long, text string, parts array<struct<start:int,end:int>>")
    got = {r.section: (r.n_bytes, r.n_tokens) for r in section_token_counts(far, "parts").collect()}
    assert got[-1][0] == 23 - 5 and sum(n for _, n in got.values()) == 5
    assert section_token_counts(no_docs).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script><style>p{}</style></head><body class="has-sidebar"><nav><ul><li><a href=/a>Menu</a></ul></nav>
<div class="ad">Buy this now, it is very cheap today. Really.</div>%s<div id="comments"><p>I am a reader and I say that this is a fine text. Yes.</p></div>
<form>Your name <input></form><footer>&copy; 2024</footer></body></html>"""
BODY = """<h1>The &lt;b&gt; title</h1><p>First &amp; long   paragraph,\nwhich <b>goes</b> on<br>for some time, so that nobody can take it for a menu. It ends here.
<p>Short one.<ul><li>item<li>other</ul><p><i>Another paragraph that is long enough to be seen as text, and ends with a full stop.</i></p>"""
BLOCKS = ["The <b> title", "First & long paragraph, which goes on for some time, so that nobody can take it for a menu. It ends here.", "Short one.", "item", "other",
          "Another paragraph that is long enough to be seen as text, and ends with a full stop."]


def test_main_text(spark):
    pages = [(1, "u", PAGE % f"<article>{BODY}</article>"), (2, None, None), (3, "v", ""), (4, "w", "<"), (None, "x", PAGE % f"<main>{BODY}</main>"),
             (5, "y", (PAGE % f"<article>{BODY}")[:700]), (1, "u", PAGE % f"<article>{BODY}</article>"), (6, "z", "<div>" * 3000 + "x")]
    got = main_text(spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as label")).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.n_chars == len(r.text)
        if r.page_id in (1, None):
            assert r.text == "\n\n".join(BLOCKS)
        if r.page_id in (2, 3, 4):
            assert r.text == ""
        assert "Menu" not in r.text and "reader" not in r.text and "Buy" not in r.text
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_class_words_do_not_take_the_text(spark):
    """Names that hold a word for side blocks, a page in one form, and a named block inside the article."""
    body = BODY * 2
    pages = [
        (1, f'<body><div class="ad">Buy now.</div><div class="content no-sidebar">{body}</div><div class="sidebar">More <a href=x>links</a></div></body>'),
        (2, f'<body><form action="/x"><div>{body}</div><input></form><form>Your name <input></form></body>'),
        (3, f'<body><article><div class="read-more-content">{body}</div><div class="share">Share this</div></article></body>'),
        (4, f'<body><article>{body}<form>Leave your mail here. It is free of charge.</form><div class="ad">Buy this now. It is cheap.</div></article></body>'),
    ] + [(k, PAGE % f"<article>{BODY}</article>") for k in range(10, 40)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame([(i, "u", h) for i, h in pages], "page_id long, url string, html string")).collect()}
    for k in (1, 2, 3, 4):
        assert BLOCKS[1] in got[k] and BLOCKS[-1] in got[k], k
        assert not any(x in got[k] for x in ("Buy", "links", "Your name", "Share", "mail")), k


def test_marginals_equal_enumeration():
    root = page_tree("<div><p>A short one</p><div><p>A longer paragraph that has a sentence in it. Yes.</p><p><a href=x>link</a></p></div>tail text</div>")
    model = Model({})
    order, parents, stack = [], [], [(root, -1)]
    while stack:
        node, parent = stack.pop()
        parents.append(parent)
        order.append(node)
        stack += [(c, len(order) - 1) for c in reversed(node.children)]
    weight = {}
    for code in range(2 ** (len(order) - 1)):
        labels = [0, *((code >> k) & 1 for k in range(len(order) - 1))]
        score = sum(model.own(n)[labels[k]] for k, n in enumerate(order)) + sum(model.given["edge"][labels[parents[k]]][labels[k]] for k in range(1, len(order)))
        weight[tuple(labels)] = math.exp(score)
    expected = [n.text for k, n in enumerate(order) if n.tag is None and sum(w for x, w in weight.items() if x[k]) > 0.5 * sum(weight.values())]
    assert model.content(root) == expected


def test_reading_pages():
    root = read("<p>a<p>b<table><tr><td>c<td>d</table><!-- x --><textarea><p>no</textarea><b>e</i> f", lambda *_: False)
    texts, stack = [], [root]
    while stack:
        node = stack.pop()
        texts += [node.text] if node.tag is None else []
        stack += reversed(node.children)
    assert texts == ["a", "b", "c", "d", "e f"]
    assert never("div", ' class="post-comments"') and not never("div", ' class="content"') and never("header", "") and not never("header", "", True)
    assert features(root) == [] and "article" in MAIN


def test_pipeline_equals_brute_force(spark, tmp_path, edge_rows):
    from tests.llm.test_jaccard_join import brute
    from tests.llm.test_texts import base_spans

    passage = words(900, 40)
    docs = [(k, words(k, 100), "en", "s", 1) for k in range(20, 40)]
    docs += [(50, words(20, 100), "en", "s", 1), (51, words(21, 100) + " more", "de", "s", 1), (52, words(60, 90) + " " + passage, "en", "s", 1),
             (53, words(61, 90) + " write to a.b@c.de or +1 (555) 123-4567", "en", "s", 1)]
    folder = str(tmp_path / "sf")
    spark.createDataFrame([*edge_rows, *docs], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    table = spark.read.parquet(f"{folder}/documents.parquet")
    kept = table
    for name, stage in corpus_pipeline.STAGES[:1]:
        kept = stage(spark, table, folder)
        assert kept.columns == list(corpus_pipeline.COLUMNS)
    first = [(r.doc_id, r.text) for r in kept.collect()]
    assert {i for i, _ in first} >= {1, 2, 20, 39, 50, 52, 53} and not {i for i, _ in first} & {4, 5, 6, 7, 8, 12}
    groups = {(i, n): c for i, n, c in brute(first, 5, 80)}
    second = {i: t for (i, _), c in groups.items() for j, t in first if j == i and (c == i or i is None)}
    third = {i: t for i, t in second.items() if passage not in (t or "")}
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    expected = {}
    for i, t in third.items():
        for span in sorted(base_spans(t), key=lambda s: -int(s.split(":")[1])):
            kind, a, b = span.split(":")
            t = t[:int(a)] + f"[{kind.upper()}]" + t[int(b):]
        expected[i] = model.encode(t)
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, folder).collect()}
    assert got == expected and 53 in got and 52 not in got and 50 not in got and 2 not in got
    empty = str(tmp_path / "none")
    spark.createDataFrame([], DOCS).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] and re.match("quality", corpus_pipeline.STAGES[0][0])
