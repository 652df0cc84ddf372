import collections
import hashlib
import re

from llm.conftest import SF001, awkward, frame, table
from quakeframe.llm import pii, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NAMES = ("email", "ip", "card", "phone")


def digits(s):
    return [int(c) for c in s if c in "0123456789"]


def luhn(s):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits(s)))) % 10 == 0


def brute(text):
    t = text or ""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 12 <= len(digits(m[0])) <= 19 and luhn(m[0])]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


TRICKY = [
    "a@b.c+x@y.com, a..b@c-d.e.f. @x.y a@b a@b.", "ä@b.cd é a_b%c@d.e", "1.2.3.4.5.6.7.8 999.1.1.1 0255.1.1.1 256.0.0.0 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 12345678901234567890 4111  111111111111", "+1 (269) 555-3296+44 20 7946 0958 +1 +12345 +(1)2345678 +1 555 5555 55",
    "0 0-0 00000000000 0000000000000000 " * 3, "🙂 x@y.zz 🙂 10.0.0.1 🙂 +49 (30) 123456-78", "a@b.c" * 40, "+" * 50 + "1" * 12, "1-2 3-4 5-6 7-8 9-0 1-2 3-4",
]


def spans(df):
    found = df.select("doc_id", pii.spans_text("base").alias("b"), "n_email", "n_ip", "n_card", "n_phone")
    return collections.Counter((r.doc_id, r.b, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in found.collect())


def want(rows):
    out = collections.Counter()
    for i, t in rows:
        b = brute(t)
        out[(i, ",".join(f"{NAMES[k]}:{s}:{e}" for s, k, e in b), *[sum(x[1] == k for x in b) for k in range(4)])] += 1
    return out


def test_base_spans_against_re(spark):
    rows = awkward() + [(500 + i, t) for i, t in enumerate(TRICKY)]
    assert spans(pii.pii_spans(frame(spark, rows))) == want(rows)


def test_empty_table(spark):
    assert pii.pii_spans(frame(spark, [])).count() == 0
    assert pii.redact(frame(spark, [])).count() == 0


def training_rows():
    rows = []
    for i in range(400):
        rows.append((i, f"call me at +1 (269) 555-{3000 + i} or mail user.{i}@mail{i % 7}.example.com today"))
        rows.append((1000 + i, f"the login token = \"{i:040x}\" and the order no {i:04d} 55 66 7{i % 10} was sent"))
        rows.append((2000 + i, f"host 10.0.{i % 256}.{i % 99} version 1.2.3.{400 + i} part 4111 1111 1111 1{100 + i}"))
    return rows


def test_added_spans_keep_base_and_leave_plain_text_alone(spark):
    rows = training_rows() + [(9000, "a plain text of words and nothing else"), (9001, None)]
    out = {r.doc_id: r for r in pii.pii_spans(frame(spark, rows)).collect()}
    added = 0
    for r in out.values():
        base, every = [tuple(x) for x in r.base], [tuple(x) for x in r.spans]
        assert set(base) <= set(every) and every == sorted(every)
        for s, _, e in set(every) - set(base):
            added += 1
            assert all(e <= a or b <= s for a, _, b in base)
    assert added > 0  # the trees add the keys, which no base rule knows
    assert out[9000].spans == [] and out[9001].spans == []


def test_redaction(spark):
    text = "é mail a.b@c.de, ip 10.0.0.1 end"
    rows = [(1, text), (1, text), (2, "nothing"), (3, None), (4, "x@y.zz"), (5, "+1 (269) 555-3296 x@y.zz")]
    df = frame(spark, rows)
    out = pii.redact(df)
    assert out.columns == df.columns
    found = collections.Counter((r.doc_id, r.text) for r in out.collect())
    assert found == collections.Counter([(1, "é mail [email], ip [ip] end")] * 2 + [(2, "nothing"), (3, None), (4, "[email]"), (5, "[phone] [email]")])


def test_query_on_fixture(spark):
    rows = {r["doc_id"]: r["text"] for r in table(SF001)}
    got = queries.op4_pii(spark, SF001).collect()
    assert len(got) == len(rows)
    for r in got:
        base = ",".join(f"{NAMES[k]}:{s}:{e}" for s, k, e in brute(rows[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))


def test_plan_has_no_python(spark):
    plan = pii.scan(frame(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
