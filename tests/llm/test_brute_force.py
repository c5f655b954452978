"""Quotation linking and expectation maximisation against plain versions, row by row."""

import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tachoflow.llm.quotation_linking import ANNOUNCES, reply_threads
from tachoflow.llm.weak_labels import BAD, expectation_maximisation

MARKS = re.compile(r"^(?:[ \t]*>)+")


def _parsed(text):
    lines = []
    for line in re.split(r"\r?\n", text or ""):
        found = MARKS.match(line)
        lines.append((found[0].count(">") if found else 0, re.sub(r"^[ \t]", "", line[found.end():]) if found else line))
    return [(level, [body for _, body in part]) for level, part in itertools.groupby(lines, key=lambda x: x[0])]


def _normal(text):
    return re.sub(r"\s+", " ", text.lower()).strip(" ")


def _full(text):
    return re.search(r"[a-zA-Z0-9]", text) is not None


def plain_threads(messages):
    """(conv_id, turn, own_text, n_quotes, n_linked, max_level, parent, thread, depth) of every message."""
    rows, holders = [], {}
    for conv, turn, text in messages:
        blocks, own = _parsed(text), []
        for k, (level, body) in enumerate(blocks):
            said = [x for x in body if x.strip()]
            announced = k + 1 < len(blocks) and said and re.match(ANNOUNCES, said[-1])
            if level == 0:
                own += [x for x in body if not (announced and re.match(ANNOUNCES, x))]
        own_text = "\n".join(own).strip()
        quotes = [(level, body) for level, body in blocks if level > 0 and any(map(_full, body))]
        rows.append((conv, turn, own_text, quotes, max(level for level, _ in blocks)))
        if conv is not None and turn is not None and _full(own_text):
            for passage in {_normal(own_text), *(_normal(x) for x in own if _full(x))}:
                holders[conv, passage] = min(turn, holders.get((conv, passage), turn))
    found = defaultdict(dict)
    for conv, turn, _, quotes, _ in rows:
        if conv is None or turn is None:
            continue
        for place, (level, body) in enumerate(quotes):
            whole = holders.get((conv, _normal("\n".join(body))), turn)
            single = [holders.get((conv, _normal(x)), turn) for x in body if _full(x)]
            hits = [whole] if whole < turn else [t for t in single if t < turn]
            if hits:
                found[conv, turn].setdefault((place, level), []).append((whole < turn, max(hits)))
    parents, linked = {}, {}
    for key, places in found.items():
        best = {p: max([t for w, t in hits if w] or [t for _, t in hits]) for p, hits in places.items()}
        linked[key] = len({place for place, _ in best})
        answered = [t for (_, level), t in best.items() if level == 1]
        if answered:
            parents[key] = max(answered)
    out = []
    for conv, turn, own_text, quotes, level in rows:
        thread, depth = turn, 0
        while (conv, thread) in parents:
            thread, depth = parents[conv, thread], depth + 1
        out.append((conv, turn, own_text, len(quotes), linked.get((conv, turn), 0), level, parents.get((conv, turn)), thread, depth))
    return sorted(out, key=str)


def _conversations(seed):
    rng = random.Random(seed)
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    out = []
    for conv in range(12):
        said = []
        for turn in range(rng.randint(1, 9)):
            own = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 3))]
            lines = []
            for _ in range(rng.randint(0, 2)):
                if said:
                    if rng.random() < 0.5:
                        lines += rng.choice(("Ann wrote:", "On Monday Bob wrote:", "well")).split("\n")
                    source = rng.choice(said)
                    part = source if rng.random() < 0.5 else source[:1]
                    lines += [rng.choice(("> ", ">", "  > ", "> > ", ">>")) + (x.upper() if rng.random() < 0.3 else x) for x in part]
                    if rng.random() < 0.3:
                        lines += ["> not said by anyone"]
            lines += rng.choice(([], ["", ""])) + own
            out.append((conv, turn, rng.choice(("\n", "\r\n")).join(lines)))
            said.append(own)
    out += [(3, 2, "beta\n> alpha"), (3, 2, "beta\n> alpha"), (None, 1, "> alpha"), (4, None, "alpha"), (5, 20, None), (5, 21, ""), (5, 22, ">\n> >\n>  "), (6, 30, "> " * 40 + "deep")]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_reply_threads_equal_a_plain_version(spark, seed):
    messages = _conversations(seed)
    frame = spark.createDataFrame([(c, t, "user", x) for c, t, x in messages], "conv_id long, turn long, role string, text string")
    got = reply_threads(frame).select(
        "conv_id", "turn", "own_text", "n_quotes", "n_linked", "max_level", "parent_turn", "thread_turn", "reply_depth").collect()
    expected = plain_threads(messages)
    assert sorted((tuple(r) for r in got), key=str) == expected
    assert sum(r[6] is not None for r in expected) > 10 and max(r[8] for r in expected) > 1


def plain_em(votes, rounds=200):
    """EM over single texts instead of counted patterns."""
    against = [sum(v == BAD for v in row) for row in votes]
    posterior = [0.9 if a == 0 else 0.2 if a == 1 else 0.05 for a in against]
    for _ in range(rounds):
        share = (sum(posterior) + 1) / (len(votes) + 2)
        given = []
        for j in range(len(votes[0])):
            table = [[0.5] * 3, [0.5] * 3]
            for row, p in zip(votes, posterior):
                table[0][row[j]] += 1 - p
                table[1][row[j]] += p
            given.append([[x / sum(line) for x in line] for line in table])
        new = []
        for row in votes:
            bad, good = 1 - share, share
            for j, v in enumerate(row):
                bad, good = bad * given[j][0][v], good * given[j][1][v]
            new.append(good / (good + bad))
        done = max(abs(a - b) for a, b in zip(new, posterior)) < 1e-9
        posterior = new
        if done:
            break
    return posterior


def test_expectation_maximisation_equals_single_texts():
    rng = random.Random(4)
    votes = []
    for k in range(300):
        good = k % 3 > 0
        votes.append(tuple(2 if rng.random() < 0.3 else int(good if rng.random() < accuracy else not good) for accuracy in (0.95, 0.8, 0.7, 0.6)))
    patterns, counts = np.unique(np.array(votes), axis=0, return_counts=True)
    posterior, share, _ = expectation_maximisation(patterns, counts.astype(float))
    label = {tuple(p): x for p, x in zip(patterns.tolist(), posterior)}
    assert [label[v] for v in votes] == pytest.approx(plain_em(votes), abs=1e-6)
    assert 0.5 < share < 0.8
    right = sum((label[v] >= 0.5) == (k % 3 > 0) for k, v in enumerate(votes))
    assert right / len(votes) > 0.9
