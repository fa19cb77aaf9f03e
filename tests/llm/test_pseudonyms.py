"""The pseudonyms against a plain finder, validator and Feistel network."""

import datetime as dt
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from sensorloom.llm import feistel_pii

KEY, FIRST = "key", dt.date(1900, 1, 1)
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(kind, turn, half):
    return hashlib.sha256(f"{KEY}|{kind}|{turn}|{half}".encode()).hexdigest()


def permute_number(n, size, kind):
    left, right = divmod(n, size)
    for turn in range(0, 8, 2):
        left = (left + int(digest(kind, turn, right)[:12], 16)) % size
        right = (right + int(digest(kind, turn + 1, left)[:12], 16)) % size
    return left * size + right


def permute_text(text, kind):
    def mix(half, other, turn):
        code, out = digest(kind, turn, other), ""
        for i, c in enumerate(half):
            by = int(code[4 * (i % 16) : 4 * (i % 16) + 4], 16)
            alphabet = next((a for a in (DIGITS, LOWER, UPPER) if c in a), None)
            out += alphabet[(alphabet.index(c) + by) % len(alphabet)] if alphabet else c
        return out

    left, right = text[: len(text) // 2], text[len(text) // 2 :]
    for turn in range(0, 8, 2):
        left = mix(left, right, turn)
        right = mix(right, left, turn + 1)
    return left + right


def fill(match, digits):
    rest = iter(digits)
    return "".join(next(rest) if c in DIGITS else c for c in match)


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def day_of(year, month, day):
    try:
        found = dt.date(int(year), int(month), int(day))
    except ValueError:
        return None
    return found if 1900 <= found.year <= 2099 else None


def date_pseudonym(match):
    mark = next(c for c in match if c in "./-")
    a, b, c = match.split(mark)
    if len(a) == 4:
        day, order = day_of(a, b, c), "ymd"
    else:
        day, order = day_of(c, b, a), "dmy"
        if day is None:
            day, order = day_of(c, a, b), "mdy"
    if day is None:
        return None
    n = (day - FIRST).days
    while True:
        n = permute_number(n, 271, "date")
        if n < 73049 and ((FIRST + dt.timedelta(n)).day <= 12) == (day.day <= 12):
            break
    new = FIRST + dt.timedelta(n)
    part = {"y": new.year, "m": new.month, "d": new.day}
    return mark.join(str(part[o]).zfill(2) if len(t) == 2 else str(part[o]) for o, t in zip(order, (a, b, c)))


def card_pseudonym(match):
    digits = "".join(c for c in match if c in DIGITS)
    if not luhn(digits):
        return "account", fill(match, permute_text(digits, "account"))
    payload = permute_text(digits[:-1], "card")
    return "card", fill(match, payload + next(d for d in DIGITS if luhn(payload + d)))


def at_place(text, i):
    """The kind, length and pseudonym of what starts at ``i``; no kind where validation fails."""
    rest, before = text[i:], text[:i]
    m = re.match(r"([\w.%+-]{1,64})@([A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24})", rest, re.A)
    if m:
        return "email", m.end(), permute_text(m[1], "email") + "@" + m[2]
    m = re.match(r"(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})(?!\.?\d)", rest, re.A)
    if m and not re.search(r"[\d.]\Z", before, re.A) and all(int(o) < 256 and str(int(o)) == o for o in m.groups()):
        n = permute_number(int.from_bytes(bytes(map(int, m.groups())), "big"), 65536, "ip")
        return "ip", m.end(), ".".join(str(o) for o in n.to_bytes(4, "big"))
    m = re.match(r"((19|20)\d\d([/-])\d\d?\3\d\d?|\d\d?([./])\d\d?\4(19|20)\d\d)(?![./-]?\d)", rest, re.A)
    if m and not re.search(r"[\d./-]\Z", before, re.A):
        new = date_pseudonym(m[0])
        return new and "date", m.end(), new
    m = re.match(r"(\+\d{1,3}[ .-]?)?(\(?\d{3}\)?[ .-]?\d{3}([ .-]?)\d{4})(?!\d)", rest, re.A)
    if m and not re.search(r"[\d+]\Z", before, re.A) and (m[1] or m[3]):
        return "phone", m.end(), (m[1] or "") + fill(m[2], permute_text(re.sub(r"\D", "", m[2]), "phone"))
    if not re.search(r"\d\Z", before, re.A):
        m = re.match(r"\d([ -]?\d){12,18}(?!\d)", rest, re.A)
        if m:
            kind, new = card_pseudonym(m[0])
            return kind, m.end(), new
    if not re.search(r"[A-Za-z0-9_]\Z|\d[.,]\Z", before, re.A):
        m = re.match(r"(\d{9,12}|\d{3} \d\d \d{4})(?![A-Za-z0-9_])", rest, re.A)
        if not m:
            m = re.match(r"\d+(-\d+)+", rest, re.A)
            groups = m[0].split("-") if m else []
            fits = 2 <= len(groups) <= 4 and all(2 <= len(g) <= 6 for g in groups) and 9 <= sum(map(len, groups)) <= 12
            m = m if fits and not re.match(r"[A-Za-z0-9_]", rest[m.end() :]) else None
        if m:
            digits = re.sub(r"\D", "", m[0])
            kind = "phone" if len(digits) == 10 else "account"
            return kind, m.end(), fill(m[0], permute_text(digits, kind))
    return None


def plain(text):
    out, kinds, i = "", [], 0
    while i < len(text):
        found = at_place(text, i)
        if found is None:
            out, i = out + text[i], i + 1
            continue
        kind, length, new = found
        out += new if kind else text[i : i + length]
        kinds += [kind] if kind else []
        i += length
    return out, {f"n_{k}": kinds.count(k) for k in feistel_pii.KINDS}


PIECES = [
    "123-45-6789", "123456789", "123 45 6789", "4155551234", "415-555-1234", "+1 (415) 555-1234", "+14155551234",
    "+442071838750", "12/25/2020", "25.12.2020", "1/2/2020", "2099-12-31", "2020-1-2", "2020/12/25", "31.02.2001",
    "29.2.2000", "29.2.1900", "123456789012", "12345678901", "12-3456-7890", "1234-5678-9012", "12-34", "0.123456789", "3,1234567890",
    "ab123456789", "123456789_x", "4111-1111-1111-1111", "4111 1111 1111 1112", "12345678901234567890", "10.0.0.1", "300.1.1.1",
    "1.2.3.4.5", "Jo.Do+x@mail.example.org", "x@y", "2019 2020 2021", "12-415-555-1234", "13/13/2020", "99-99-99-99-99", "é123456789",
]


def test_pseudonyms_match_a_plain_network(spark):
    rng = random.Random(5)
    texts = PIECES + [rng.choice([" ", ", ", "; ", "\n", "-", ""]).join(rng.sample(PIECES, rng.randint(2, 6))) for _ in range(250)]
    texts += ["".join(rng.choice("0123456789  --./@a+") for _ in range(60)) for _ in range(250)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in feistel_pii.pseudonymised(frame, KEY).collect():
        text, counts = plain(texts[row["doc_id"]])
        assert (row["text"], {k: row[k] for k in counts}) == (text, counts), texts[row["doc_id"]]


def test_every_day_has_a_day_of_its_own(spark):
    days = spark.range(feistel_pii.DAYS).repartition(4).select("id", feistel_pii.permuted_day(F.col("id"), F.lit(KEY)).alias("to"))
    early = lambda c: F.dayofmonth(F.date_add(F.lit("1900-01-01").cast("date"), F.col(c).cast("int"))) <= 12
    found = days.agg(
        F.count_distinct("to").alias("n"), F.min("to").alias("low"), F.max("to").alias("high"),
        F.count_if(early("id") != early("to")).alias("moved"), F.count_if(F.col("id") == F.col("to")).alias("same"),
    ).first()
    assert (found["n"], found["low"], found["high"], found["moved"]) == (73049, 0, 73048, 0) and found["same"] < 20


@pytest.mark.parametrize(
    "alike",
    [
        ["12/25/2020", "25.12.2020", "2020-12-25", "2020/12/25", "25/12/2020"],
        ["1/2/2020", "01.02.2020", "2020-2-1"],
        ["4155551234", "(415) 555-1234", "+1 415 555 1234", "+14155551234"],
        ["123-45-6789", "123456789", "123 45 6789"],
        ["123456789012", "1234-5678-9012"],
    ],
)
def test_a_value_has_one_pseudonym_in_all_notations(spark, alike):
    frame = spark.createDataFrame(list(enumerate(alike)), "doc_id long, text string")
    found = [r["text"] for r in feistel_pii.pseudonymised(frame, KEY).orderBy("doc_id").collect()]

    def value(text):
        if re.search("[./]|^[0-9]{4}-[0-9]{1,2}-", text) and "+" not in text and "(" not in text:
            parts = [int(p) for p in re.split("[./-]", text)]
            year, rest = max(parts), [p for p in parts if p != max(parts)]
            return year, tuple(sorted(rest))
        return re.sub("[^0-9]", "", text)[-10:] if len(re.sub("[^0-9]", "", text)) == 11 else re.sub("[^0-9]", "", text)

    assert len({value(t) for t in found}) == 1 and not set(found) & set(alike)


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "123-45-6789", 7, 8, "x")], "doc_id long, text string, N_Email int, row int, `a.``b` string")
    out = feistel_pii.pseudonymised(frame, KEY)
    assert out.columns == ["doc_id", "text", "row", "a.`b", *(f"n_{k}" for k in feistel_pii.KINDS)]
    row = out.first()
    assert (row["row"], row["a.`b"], row["n_account"], row["n_email"]) == (8, "x", 1, 0)
