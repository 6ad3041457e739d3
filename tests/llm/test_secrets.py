from __future__ import annotations

import random
import re
import tracemalloc

from salesmart.llm import secrets

# The rules as patterns for a search by Python.
PLAIN = [
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
    ("chat", re.compile("xox[abprs]-[0-9A-Za-z-]{10,}"), 0, 0),
    ("private", re.compile("-----BEGIN [A-Z ]*PRIVATE KEY-----"), 0, 0),
]


def brute(text):
    found = [
        (m.start(), i, m.end())
        for i, (_, pattern, group, least) in enumerate(PLAIN)
        for m in pattern.finditer(text)
        if len(m[group]) >= least
    ]
    return [(PLAIN[i][0], a, b) for a, i, b in sorted(found)]


def test_random_texts_against_plain_search():
    draw = random.Random(1)
    parts = ["token", "Secret", "=", ":", " ", '"', "'", "AKIA", "0123456789abcdef", "ABCDEF", "api_key", "apikey", "passwd", "PassWord"]
    parts += ["é", "\U0001f600", "K", "ſ", "x", "abc", "ABC123DEF", "xoxb-", "-----BEGIN RSA PRIVATE KEY-----", "\n", "_", "-"]
    scan = secrets.scanner(secrets.RULES).scan
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randint(1, 25)))
        assert scan(text) == brute(text), text


def test_dropped_match_uses_up_its_text():
    scan = secrets.scanner(secrets.RULES).scan
    assert scan("secret=token : abcdefgh") == []  # 'token' is the short value of the first match
    assert [k for k, *_ in scan("secret=token1 : abcdefgh")] == ["assign"]


def test_minimisation_keeps_states_that_differ():
    forward = secrets.build((secrets.Rule("a", b"ab|cb"),), backwards=False, anywhere=False)
    assert len(forward.table) // (max(forward.classes) + 1) == 4  # start, after a or c, end, dead


def test_awkward_rows(awkward, clashing, no_docs):
    rows = secrets.find_secrets(awkward).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert [(s["kind"], s["start"], s["end"]) for s in r["secrets"]] == brute(r["text"] or "")
    again = secrets.find_secrets(clashing)
    assert again.columns.count("secrets") == 1 and "fp" in again.columns
    assert again.count() == len(rows)
    assert secrets.find_secrets(no_docs).collect() == []


def test_ties_and_long_texts(make_docs):
    text = "token=" + "a1" * 50_000 + " é " + "f" * 30
    found = secrets.find_secrets(make_docs([(1, text, None, None, None)] * 2)).collect()
    assert found[0]["secrets"] == found[1]["secrets"]
    assert [(s["kind"], s["start"], s["end"]) for s in found[0]["secrets"]] == brute(text)


def test_memory_follows_matches_not_bytes():
    scanner = secrets.scanner(secrets.RULES)
    for part in ("a1b2", "AKIA", "token=abcdef01 "):
        text = part * (100_000 // len(part))
        tracemalloc.start()
        spans = scanner.scan(text)
        _, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert spans == brute(text)
        assert peak < 12 * len(text) + 400 * len(spans), part
    low, high, owners = scanner.beginnings(b"a1b2" * 1000)
    assert (list(low), list(high), len(owners)) == ([0], [4000 - 24], 1)


def test_matches_that_end_within_a_run_of_beginnings():
    pairs = secrets.Scanner((secrets.Rule("two", b"[ab]{2}"), secrets.Rule("three", b"[abc]{3}")))
    draw = random.Random(3)
    for _ in range(500):
        text = "".join(draw.choices("abcd", k=draw.randint(0, 20)))
        want = [(m.start(), i, m.end()) for i, p in enumerate(("[ab]{2}", "[abc]{3}")) for m in re.finditer(p, text)]
        assert pairs.scan(text) == [(("two", "three")[i], a, b) for a, i, b in sorted(want)]
