import re

import pytest

from llm.conftest import frame
from llm.test_pii import training_rows
from quakeframe.llm import pii

#: Personal data that no fixed pattern knows, with the kind that redacts it.
PRIVATE = [
    ("call me at (269) 555-3296 today", "(269) 555-3296", "phone"),
    ("we met and (212) 555-0147. then left", "(212) 555-0147", "phone"),
    ("her telefon is 030 12345678 in the evening", "030 12345678", "phone"),
    ("phone: 07700 900123, any time", "07700 900123", "phone"),
    ("mobile 212-555-0187", "212-555-0187", "phone"),
    ("write to jane.doe (at) example (dot) com soon", "jane.doe (at) example (dot) com", "email"),
    ("it was bob[at]mail[dot]example[dot]org there", "bob[at]mail[dot]example[dot]org", "email"),
    ("ask ann.lee at example dot net about it", "ann.lee at example dot net", "email"),
    ("pay to DE89 3704 0044 0532 0130 00 please", "DE89 3704 0044 0532 0130 00", "number"),
    ("iban NO93 8601 1117 947 it was", "NO93 8601 1117 947", "number"),
    ("account BE71 0961 2345 6769 WITH 12 others", "BE71 0961 2345 6769", "number"),
    ("the ssn 219-09-9999 was given", "219-09-9999", "number"),
]
#: What only looks like it.
PLAIN = [
    "order no 0004 55 66 713 was sent", "on 2024-01-15 and 15.01.2024 it rained", "the code word DE89 3704 0044 0532 0130 01 here",
    "part 219-00-9999 fits", "we met at noon at the dot on the map", "see version 1.22.333 there",
]


def corpus(copies):
    rows = training_rows()
    for c in range(copies):
        rows += [(10_000 + 100 * c + i, f"{t}, copy {c}") for i, (t, _, _) in enumerate(PRIVATE)]
        rows += [(20_000 + 100 * c + i, f"{t}, copy {c}") for i, t in enumerate(PLAIN)]
    return rows


@pytest.mark.parametrize("copies", [1, 40])
def test_what_no_fixed_pattern_knows_is_redacted(spark, copies):
    texts = {r.doc_id: r.text for r in pii.redact(frame(spark, corpus(copies))).collect()}
    lost = [(texts[10_000 + 100 * c + i], i) for c in range(copies) for i, (t, m, k) in enumerate(PRIVATE) if texts[10_000 + 100 * c + i] != f"{t.replace(m, f'[{k}]')}, copy {c}"]
    touched = [texts[20_000 + 100 * c + i] for c in range(copies) for i, t in enumerate(PLAIN) if texts[20_000 + 100 * c + i] != f"{t}, copy {c}"]
    assert not lost and not touched


def test_without_both_labels_the_evidence_decides(spark):
    rows = [(i, t) for i, (t, _, _) in enumerate(PRIVATE)]
    for r in pii.redact(frame(spark, rows)).collect():
        t, m, k = PRIVATE[r.doc_id]
        assert r.text == t.replace(m, f"[{k}]")


def brute_check(m):
    m = m.replace(" ", "")
    return int("".join(str(int(x, 36)) for x in m[4:] + m[:4])) % 97 == 1


def test_check_digits(spark):
    numbers = [m for _, m, _ in PRIVATE if re.match("[A-Z]{2}[0-9]", m)] + ["GB29 NWBK 6016 1331 9268 19", "FR1420041010050500013M02606", "XX00 0000 0000 0000"]
    numbers += [n[:-1] + x for n in numbers for x in "0379A"]
    df = spark.createDataFrame([(n,) for n in numbers], "m string")
    for r in df.select("m", pii._check_digits(df["m"]).alias("ok")).collect():
        assert r.ok == brute_check(r.m), r.m
