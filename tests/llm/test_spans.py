"""Personal data and secrets against plain regular expressions."""

import hashlib
import random
import re

import pytest

from tidemark.llm import op_queries, personal
from tidemark.llm import secrets as rules
from tidemark.llm.automaton import Automaton, parse
from tidemark.llm.spans import digest

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0


def plain_personal(t):
    bare = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, "email", m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, "ip", m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, "card", m.end()) for m in CARD.finditer(t) if 14 <= len(bare(m)) <= 19 and luhn(bare(m))]
    out += [(m.start(), 3, "phone", m.end()) for m in PHONE.finditer(t) if 10 <= len(bare(m)) <= 15]
    return [(k, a, b) for a, _, k, b in sorted(out)]


def plain_secrets(t):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return [(k, a, b) for a, _, k, b in sorted(out)]


PERSONAL_BITS = [
    "a", "b.c", "@", "@@", ".", "..", "-", " ", "+", "+1", "1", "12", "255", "256", "192.168", ".0", "4111111111111111",
    "4111 1111", "-1111", "(", ")", "555", "é", "x@y.z", "%", "_", "\n", "iban ", "http://", "1.2.3.4", "00", "٣",
]
SECRET_BITS = [
    "password", "PassWD", "secret", "Token", "api_key", "apikey", "=", ":", "==", '"', "'", " ", "  ", "AKIA", "AKIAKIA",
    "ABCDEFGH", "0123456789", "abcdef", "deadbeefdeadbeef", "é", "ñ漢", ".", "/", "token=", 'secret:"', "x", "Z" * 14, "\n",
]


def test_base_spans_equal_the_patterns():
    draw, scan = random.Random(5), rules.scanner(rules.BASE + rules.ADDED)
    for _ in range(20000):
        t = "".join(draw.choice(PERSONAL_BITS) for _ in range(draw.randint(0, 16)))
        assert [x for x in personal.spans(t) if x[0] in personal.BASE_KINDS] == plain_personal(t), t
        t = "".join(draw.choice(SECRET_BITS) for _ in range(draw.randint(0, 14)))
        assert [x for x in scan.spans(t) if x[0] in rules.BASE_KINDS] == plain_secrets(t), t


def test_added_personal_kinds():
    t = "see http://bob@x.org/a, IBAN: DE89 3704 0044 0532 0130 00, account no. 12345678 https://a.b/users/tim."
    assert [(k, t[a:b]) for k, a, b in personal.spans(t) if k in ("url", "account")] == [
        ("url", "http://bob@x.org/a"), ("account", "DE89 3704 0044 0532 0130 00"), ("account", "12345678"),
        ("url", "https://a.b/users/tim"),
    ]
    assert personal.spans("IBAN: DE89 3704 0044 0532 0130 01; https://a.b/c accountant 5") == []


def test_added_secret_kinds():
    scan = rules.scanner(rules.BASE + rules.ADDED)
    t = f"ghp_{'A' * 36} xoxb-{'Z' * 20} -----BEGIN RSA PRIVATE KEY-----\nMII= eyJ{'a.' * 40}"
    assert [k for k, _, _ in scan.spans(t)] == ["github", "slack", "pem", "jwt"]


@pytest.mark.parametrize("pattern", ["a(b|c)*d", "(ab|a)(bc|c)?", "[a-c]{2,}d?", "x?y+z{3}"])
def test_automaton_agrees_with_re(pattern):
    auto, plain, draw = Automaton([parse(pattern)], search=False), re.compile(pattern), random.Random(1)
    for _ in range(3000):
        t = "".join(draw.choice("abcdxyz") for _ in range(draw.randint(0, 7)))
        state = auto.start
        for b in t.encode():
            state = auto.table[state + b]
        assert (state >= auto.first) == bool(plain.fullmatch(t)), t


def test_automaton_is_minimal():
    assert Automaton([parse("ab|cb")], search=False).size == 4  # start, before b, end, dead


@pytest.fixture(scope="module")
def odd(spark):
    long = "a b " * 300_000 + "x@y.org password=abcdefghijklmnop"
    rows = [(1, None, "de"), (2, "", "de"), (None, "q@r.st", None), (3, long, "fr"), (3, long, "fr"), (4, "é AKIA" + "Z" * 20, "e")]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(3)


def test_odd_rows(odd, spark):
    found = sorted(digest(personal.personal_data(odd), personal.BASE_KINDS).collect(), key=str)
    assert len(found) == 6 and sum(r.n_email for r in found) == 3
    blank = hashlib.sha256(b"").hexdigest()
    assert {(r.doc_id, r.spans, r.base_sha256) for r in found if r.doc_id in (1, 2)} == {(1, "", blank), (2, "", blank)}
    assert {r.spans for r in found if r.doc_id == 3} == {"email:1200000:1200007"}
    found = digest(rules.secrets(odd), rules.BASE_KINDS).collect()
    assert {r.spans for r in found if r.doc_id == 3} == {"assign:1200008:1200033"}
    assert {r.spans for r in found if r.doc_id == 4} == {"access:2:26"}
    masked = {r.doc_id: r.text for r in rules.without_secrets(odd).collect()}
    assert masked[4] == "é [secret]" and masked[1] is None and masked[2] == "" and masked[3].endswith("org [secret]")
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert rules.secrets(empty).count() == personal.personal_data(empty).count() == 0


def test_queries_equal_the_patterns(spark, sf):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for name, plain, kinds in (
        ("op2_personal_data", plain_personal, personal.BASE_KINDS), ("op4_secrets", plain_secrets, rules.BASE_KINDS)
    ):
        rows = op_queries.QUERIES[name](spark, sf).collect()
        assert len(rows) == len(texts)
        for r in rows:
            want = plain(texts[r.doc_id])
            line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
            assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
            assert all(r[f"n_{k}"] == sum(x[0] == k for x in want) for k in kinds)
            assert set(filter(None, line.split(","))) <= set(r.spans.split(","))
