"""Base spans by the plain patterns, and spans behind disguises."""

import hashlib
import random
import re

from airlattice.llm import private as P

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 12 <= len(digits) <= 19 and P.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], P.ORDER[s[0]]))


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(7)
    bits = ["a", "@", ".", "b-c", "12", "255", "256", "0", " ", "+1", "(", ")", "-", "4111 1111 1111 1111", "x@y.z", "1.2.3.4", "é", "\n", "4111111111111111", "+44 20 7946 0958"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 25)))
        assert P.base_spans(text) == plain_spans(text), text


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "@a" * 100_000, "+1" + " " * 200_000, "a@b" * 60_000, "one " * 50_000,
                 "a (at) b" + " " * 300_000 + "c [dot] d" + "\t" * 300_000, "(" + " " * 300_000 + "at)", "x at y" + " " * 300_000 + "dot com",
                 " ".join(f"u{k} (at) h{k} [dot] com v{k}@h.de" for k in range(20_000))):
        P.all_spans(text, P.base_spans(text))


def test_disguises_map_back_to_the_source():
    cases = {
        "mail bob.smith (at) corp [dot] example.org now": ("email", "bob.smith (at) corp [dot] example.org"),
        "call jane at corp dot example dot com ok": ("email", "jane at corp dot example dot com"),
        "tel ＋１ ２０２ 555-0143 x": ("phone", "＋１ ２０２ 555-0143"),
        "mail аbc@ехample.com.": ("email", "аbc@ехample.com"),
        "card four one one one, one one one one one one one one one one one one!": ("card", "four one one one, one one one one one one one one one one one one"),
        "ip 𝟏𝟗𝟐.168.0.1": ("ip", "𝟏𝟗𝟐.168.0.1"),
        "z​ed@ex​ample.com": ("email", "z​ed@ex​ample.com"),
    }
    for text, (kind, part) in cases.items():
        spans = P.all_spans(text, P.base_spans(text))
        assert [(k, text[a:b]) for k, a, b in spans] == [(kind, part)], text


def test_prose_stays():
    for text in ["He was at home dot the i.", "one two three four went up", "Привет, мир. Как дела?", "un deux trois", "naïve №5 ½"]:
        assert P.all_spans(text, P.base_spans(text)) == []


def test_masking():
    text = "a@b.c and 1.2.3.4"
    assert P.masked(text, P.base_spans(text)) == "[EMAIL] and [IP]"
    assert P.masked("abc", []) == "abc" and P.masked("xxxx", [("ip", 0, 3), ("card", 2, 4)]) == "[IP]"


def test_frame(frame):
    pairs = [(1, "x a@b.c +1 202 555 0143"), (2, None), (3, ""), (1, "x a@b.c +1 202 555 0143"), (4, "é 1.2.3.4 bob at corp dot com")]
    docs = frame(pairs, extra=["personal"])
    rows = P.find_personal(docs).collect()
    assert len(rows) == 5
    for r in rows:
        base = plain_spans(r.text or "")
        assert r.personal_1.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert [r.personal_1.n_email, r.personal_1.n_ip, r.personal_1.n_card, r.personal_1.n_phone] == [sum(s[0] == k for s in base) for k in P.KINDS]
    assert {r.personal_1.spans for r in rows if r.doc_id == 4} == {"ip:2:9,email:10:29"}
    masked = {r.doc_id: r.text for r in P.mask_personal(docs).collect()}
    assert P.mask_personal(docs).columns == docs.columns
    assert masked == {1: "x [EMAIL] [PHONE]", 2: None, 3: "", 4: "é [IP] [EMAIL]"}
    assert P.find_personal(frame([])).count() == 0
