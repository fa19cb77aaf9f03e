"""Format-preserving pseudonyms for personal numbers, dates and mail addresses.

Every match of a kind is validated and then permuted within its format by a keyed Feistel network, so
equal values get equal pseudonyms in all documents, different values different ones, and a pseudonym is
as valid as the value it stands for: a card number keeps its check digit right, an address its four
octets, a date is a day of the calendar. Punctuation stays, and a phone number has the same pseudonym
however it is punctuated. The round function is SHA-256 of key, kind, round and the other half.
Everything is a DataFrame expression.

Kinds, in the order in which a text is searched: ``email`` (its local part), ``ip`` (IPv4), ``date`` (a day
of 1900 to 2099, year first with - or /, or last with . or /, days and months of one or two digits; a year
last has the day first, or the month where only that is a day), ``phone`` (ten national digits after an
optional country code, or ten digits alone), ``card`` (13 to 19 digits with a right check digit) and
``account`` (9, 11 or 12 digits alone or in groups joined by -, three, two and four digits joined by
blanks, and 13 to 19 digits that are no card). What fails validation stays as it is, as do shorter and
longer numbers, digits within words and decimal places.

A day up to the twelfth of its month stays one, and a later one a later one, so that a month-first
pseudonym can only be read as such and a day has the same pseudonym in every notation.

Defined results: a null text stays null and an empty one empty, without findings; equal rows get equal
results; an empty table gives no rows. Other columns pass through, but for those named ``n_<kind>`` (in
any case), which the counts replace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.llm.common import let, quoted, row_of

ROUNDS = 8
# Formats of each kind.
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}",
    "ip": rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?[0-9])",
    "date": (
        r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}-[0-9]{1,2}-[0-9]{1,2}|(?:19|20)[0-9]{2}/[0-9]{1,2}/[0-9]{1,2}"
        r"|[0-9]{1,2}\.[0-9]{1,2}\.(?:19|20)[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/(?:19|20)[0-9]{2})(?![0-9./-]?[0-9])"
    ),
    "phone": (
        r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
        r"|\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4})(?![0-9])"
    ),
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "number": (
        r"(?<![A-Za-z0-9_])(?<![0-9][.,])(?:[0-9]{9,12}|[0-9]{3} [0-9]{2} [0-9]{4}"
        r"|(?=[0-9](?:-?[0-9]){8,11}(?!-?[0-9]))[0-9]{2,6}(?:-[0-9]{2,6}){1,3}(?!-?[0-9]))(?![A-Za-z0-9_])"
    ),
}
KINDS = ("email", "ip", "date", "phone", "card", "account")
EVERY = "|".join(f"(?:{p})" for p in PATTERNS.values())
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The first day and how many there are; the network permutes numbers below a square that holds them.
FIRST_DAY, DAYS, HALF_DAYS = "1900-01-01", 73049, 271
#: Times that a day's number is permuted until it is a day of its class. Each time a day of the smaller
#: class has two chances in five, so that all fail for one day in 10^27.
WALK = 128


def _hash(key: Column, kind: str, turn: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", key, F.lit(kind), turn.cast("string"), half.cast("string")), 256)


def _number_at(digest: Column, place: Column, size: int) -> Column:
    """Some hexadecimal digits of ``digest`` as a number."""
    return F.conv(F.substring(digest, place, F.lit(size)), 16, 10).cast("long")


def _network(left: Column, right: Column, mix) -> Column:
    """``ROUNDS`` turns in which one half is changed by ``mix(half, other, turn)``, then the other."""

    def turn(state: Column, number: Column) -> Column:
        even = number % 2 == 0
        return F.struct(
            F.when(even, mix(state["l"], state["r"], number)).otherwise(state["l"]).alias("l"),
            F.when(even, state["r"]).otherwise(mix(state["r"], state["l"], number)).alias("r"),
        )

    start = F.struct(left.alias("l"), right.alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def permuted_number(value: Column, size: int, key: Column, kind: str) -> Column:
    """A permutation of the numbers below ``size`` * ``size``."""

    def mix(half: Column, other: Column, turn: Column) -> Column:
        return (half + _number_at(_hash(key, kind, turn, other), F.lit(1), 12)) % size

    number = value.cast("long")
    halves = _network(F.floor(number / size).cast("long"), number % size, mix)
    return let(halves, lambda h: h["l"] * size + h["r"])


def permuted_text(text: Column, key: Column, kind: str) -> Column:
    """A permutation of the texts with the same kinds of characters at the same places.

    Digits stay digits and letters letters of their case; all other characters stay.
    """

    def moved(char: Column, by: Column) -> Column:
        def in_alphabet(alphabet: str) -> Column:
            place = F.instr(F.lit(alphabet), char) + (by % len(alphabet)).cast("int")
            return F.substring(F.lit(alphabet * 2), place, F.lit(1))

        return (
            F.when(char.between("0", "9"), in_alphabet(DIGITS))
            .when(char.between("a", "z"), in_alphabet(LOWER))
            .when(char.between("A", "Z"), in_alphabet(UPPER))
            .otherwise(char)
        )

    def mix(half: Column, other: Column, turn: Column) -> Column:
        def shifted(digest: Column) -> Column:
            return F.array_join(
                F.transform(F.split(half, ""), lambda c, i: moved(c, _number_at(digest, 4 * (i % 16) + 1, 4))), ""
            )

        return let(_hash(key, kind, turn, other), shifted)

    middle = F.floor(F.length(text) / 2).cast("int")
    halves = _network(F.substring(text, F.lit(1), middle), F.substring(text, middle + 1, F.length(text)), mix)
    return let(halves, lambda h: F.concat(h["l"], h["r"]))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def with_digits(text: Column, digits: Column) -> Column:
    """``text`` with its digits replaced, in order, by those of ``digits``."""
    parts = F.transform(
        F.split(text, ""),
        lambda c, i: F.when(
            c.between("0", "9"),
            F.substring(digits, F.length(digits_of(F.substring(text, F.lit(1), i + 1))), F.lit(1)),
        ).otherwise(c),
    )
    return F.array_join(parts, "")


def check_digit(payload: Column) -> Column:
    """The digit that makes ``payload`` followed by it pass the Luhn check."""

    def add(total: Column, part: Column) -> Column:
        return total + part

    values = F.transform(
        F.split(F.reverse(payload), ""),
        lambda c, i: F.when(c == "", 0).when(i % 2 == 0, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5)).otherwise(
            c.cast("int")
        ).cast("int"),
    )
    return ((10 - F.aggregate(values, F.lit(0), add) % 10) % 10).cast("string")


def _is_card(digits: Column) -> Column:
    payload = F.substring(digits, F.lit(1), F.length(digits) - 1)
    return check_digit(payload) == F.substring(digits, F.length(digits), F.lit(1))


def _dated(match: Column) -> Column:
    """What a date means: ``day``, as days after the first (null where it isn't one of them), and whether
    its year stands first and its month before its day."""
    parts = F.split(match, "[./-]")
    year_first = F.length(parts[0]) == 4

    def days(*order: int) -> Column:
        day = F.try_to_date(F.concat_ws("-", *[parts[i] for i in order]), "yyyy-M-d")
        after = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
        return F.when((after >= 0) & (after < DAYS), after)

    def of(day_first: Column) -> Column:
        return F.struct(
            F.when(year_first, days(0, 1, 2)).otherwise(F.coalesce(day_first, days(2, 0, 1))).alias("day"),
            year_first.alias("year_first"),
            (~year_first & day_first.isNull()).alias("month_first"),
        )

    return let(days(2, 1, 0), of)


def permuted_day(day: Column, key: Column) -> Column:
    """A permutation of the days, and of those up to the twelfth of a month among themselves.

    The number of a day is permuted until it again is the number of such a day.
    """

    def early(number: Column) -> Column:
        return F.dayofmonth(F.date_add(F.lit(FIRST_DAY).cast("date"), number.cast("int"))) <= 12

    def step(state: Column, _: Column) -> Column:
        moved = let(
            permuted_number(state["n"], HALF_DAYS, key, "date"),
            lambda n: F.struct(n.alias("n"), ((n < DAYS) & (early(n) == early(day))).alias("done")),
        )
        return F.when(state["done"], state).otherwise(moved)

    start = F.struct(day.cast("long").alias("n"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), start, step)["n"]


def _date_like(match: Column, key: Column) -> Column:
    """The pseudonym of a date in its notation; parts of two digits keep them."""
    parts, mark = F.split(match, "[./-]"), F.regexp_extract(match, "[./-]", 0)

    def part(value: Column, place: int) -> Column:
        text = value.cast("string")
        return F.when(F.length(parts[place]) == 2, F.lpad(text, 2, "0")).otherwise(text)

    def joined(first: Column, second: Column, third: Column) -> Column:
        return F.concat(first, mark, second, mark, third)

    def as_text(dated: Column) -> Column:
        def of(d: Column) -> Column:
            year, month, day = F.year(d), F.month(d), F.dayofmonth(d)
            return (
                F.when(dated["year_first"], joined(part(year, 0), part(month, 1), part(day, 2)))
                .when(dated["month_first"], joined(part(month, 0), part(day, 1), part(year, 2)))
                .otherwise(joined(part(day, 0), part(month, 1), part(year, 2)))
            )

        return let(F.date_add(F.lit(FIRST_DAY).cast("date"), permuted_day(dated["day"], key).cast("int")), of)

    return let(_dated(match), as_text)


def kind_of(match: Column) -> Column:
    """The kind of a match of ``EVERY``, or null where validation fails."""
    whole = {name: match.rlike(f"^(?:{p})$") for name, p in PATTERNS.items()}
    return (
        F.when(whole["email"], F.lit("email"))
        .when(whole["ip"], F.lit("ip"))
        .when(whole["date"], F.when(_dated(match)["day"].isNotNull(), F.lit("date")))
        .when(whole["phone"], F.lit("phone"))
        .when(whole["card"], F.when(_is_card(digits_of(match)), F.lit("card")).otherwise(F.lit("account")))
        .when(whole["number"], F.when(F.length(digits_of(match)) == 10, F.lit("phone")).otherwise(F.lit("account")))
    )


def pseudonym(match: Column, kind: Column, key: Column) -> Column:
    """The pseudonym of one match."""
    at = F.instr(match, F.lit("@"))
    email = F.concat(
        permuted_text(F.substring(match, F.lit(1), at - 1), key, "email"), F.substring(match, at, F.length(match))
    )
    octets = F.split(match, r"\.")
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda total, o: total * 256 + o.cast("long"))
    ip = let(
        permuted_number(number, 65536, key, "ip"),
        lambda n: F.concat_ws(".", *[F.floor(n / 256**i % 256).cast("long").cast("string") for i in (3, 2, 1, 0)]),
    )
    date = _date_like(match, key)
    # All digits but those of a country code are the national number.
    code = F.length(F.regexp_extract(match, r"^\+[0-9]{1,3}[ .-]?(?=\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}$)", 0))
    national = F.substring(match, code + 1, F.length(match))
    phone = F.concat(
        F.substring(match, F.lit(1), code), with_digits(national, permuted_text(digits_of(national), key, "phone"))
    )
    digits = digits_of(match)
    payload = permuted_text(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    card = with_digits(match, let(payload, lambda p: F.concat(p, check_digit(p))))
    account = with_digits(match, permuted_text(digits, key, "account"))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "date", date)
        .when(kind == "phone", phone)
        .when(kind == "card", card)
        .when(kind == "account", account)
        .otherwise(match)
    )


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and ``n_<kind>``, how many values of each kind it had.

    A text is cut at its matches (``split`` gives the gaps between them) and put together again.
    """
    secret = F.lit(key)

    def replaced(text: Column) -> Column:
        def of(match: Column) -> Column:
            return let(
                kind_of(match), lambda k: F.struct(k.alias("kind"), pseudonym(match, k, secret).alias("new"))
            )

        found = F.transform(F.regexp_extract_all(text, F.lit(EVERY), F.lit(0)), of)
        gaps = F.split(text, EVERY, -1)
        return F.struct(
            F.array_join(F.zip_with(gaps, found, lambda g, f: F.concat(g, F.coalesce(f["new"], F.lit("")))), "").alias("text"),
            F.transform(found, lambda f: f["kind"]).alias("kinds"),
        )

    # Nothing to look for in a text without digits or an at sign.
    suspect = F.col("text").rlike("[0-9@]")
    packed = docs.select(row_of(docs), F.when(suspect, replaced(F.col("text"))).alias("found"))
    kinds = F.coalesce(F.col("found.kinds"), F.array().cast("array<string>"))
    counts = {f"n_{name}" for name in KINDS}
    text = F.coalesce("found.text", "row.text").alias("text")
    columns = [
        text if c == "text" else F.col(f"row.{quoted(c)}") for c in docs.columns if c.lower() not in counts
    ]
    return packed.select(*columns, *[_count(kinds, name) for name in KINDS])


def _count(kinds: Column, name: str) -> Column:
    return F.size(F.filter(kinds, lambda k: k == name)).cast("long").alias(f"n_{name}")
