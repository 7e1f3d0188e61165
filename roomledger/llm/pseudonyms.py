"""Format-preserving pseudonyms: private values are permuted by keyed Feistel rounds within their own format.

A value is found by its shape, validated (check digits, ranges, calendar), and
sent to another valid value of the same shape: cards and account numbers keep
a right check digit, dates stay dates written in the same order with as many
digits, addresses stay addresses. The permutation depends on the key and the
kind alone, so equal values get equal pseudonyms in all documents, and
different values different ones. Marks between digits and the case of letters
stay, and do not change the pseudonym. Dates with two-digit days before months
go where the same dates with the year first go; those of other shapes are
permuted among the dates of their own shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY, DAY_SIDES = "1900-01-01", (270, 271)  # 73,170 days, up to 2100-05-01
FIRST_YEAR, LAST_YEAR = 1900, 2100
FIRST_LEAP, LAST_LEAP = 1904, 2096
LETTERS = "abcdefghijklmnopqrstuvwxyz"
ACCENTED = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ"
# The shapes that are looked for. The first that fits counts.
EMAIL = r"[\p{IsLatin}0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([./-])[0-9]{1,2}\1[0-9]{4}"
ADDRESS = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
INSURED = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
ACCOUNT = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
PHONE = r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}"
CARD = r"[0-9](?:[ -]?[0-9]){12,18}"
SECRET = r"(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}|[0-9A-F]{64}|[0-9A-F]{40}|[0-9A-F]{32})"
# Values may stand beside letters of scripts without spaces, and dates before a time of day.
ANY = (
    r"(?<![\p{IsLatin}\p{N}._%+@-])(?:" + "|".join(s.replace("([./-])", "(?:[./-])").replace(r"\1", "[./-]") for s in (
        EMAIL, DATE, ADDRESS, INSURED, ACCOUNT, SECRET, PHONE, CARD))
    + r")(?:(?![\p{IsLatin}\p{N}@]|[.-][0-9])|(?<=[0-9]{4}-[0-9]{2}-[0-9]{2})(?=T[0-9]{2}))"
)


def _number(key: str, kind: str, *parts: Column) -> Column:
    """A number of 60 bits from a key, a kind and some values."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def permuted_pair(left: Column, right: Column, left_size: Column, right_size: Column, key: str, kind: str) -> Column:
    """A struct (left, right) below the two sizes that another such pair has been sent to, one to one."""

    def step(s: Column, n: Column) -> Column:
        moved = F.pmod(s["left"] + F.pmod(_number(key, kind, n, s["right"]), left_size), left_size)
        other = F.pmod(s["right"] + F.pmod(_number(key, kind, n, s["left"]), right_size), right_size)
        return F.struct(
            F.when(n % 2 == 1, moved).otherwise(s["left"]).alias("left"),
            F.when(n % 2 == 1, s["right"]).otherwise(other).alias("right"),
        )

    start = F.struct(left.cast("long").alias("left"), right.cast("long").alias("right"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _shifted(char: Column, by: Column, letters: str) -> Column:
    """A digit or letter moved on in its own class; other characters stay."""

    def within(alphabet: str, at: Column) -> Column:
        return F.substr(F.lit(alphabet), (F.pmod(at + F.pmod(by, F.lit(len(alphabet))), F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))

    classes = ["0123456789", letters, letters.upper()]
    if letters == LETTERS:
        classes += [ACCENTED, ACCENTED.upper()]
    moved = F.when(char == "", char)
    for alphabet in classes:
        at = F.instr(F.lit(alphabet), char)
        moved = moved.when(at > 0, within(alphabet, at - 1))
    return moved.otherwise(char)


def permuted_text(text: Column, key: str, kind: str, letters: str = LETTERS) -> Column:
    """A text of the same length and the same classes of characters that another one has been sent to, one to one."""

    def mixed(own: Column, other: Column, n: Column) -> Column:
        chars = F.split(own, "")
        return F.array_join(F.transform(chars, lambda c, i: _shifted(c, _number(key, kind, n, F.lower(other), i), letters)), "")

    def step(s: Column, n: Column) -> Column:
        return F.struct(
            F.when(n % 2 == 1, mixed(s["left"], s["right"], n)).otherwise(s["left"]).alias("left"),
            F.when(n % 2 == 1, s["right"]).otherwise(mixed(s["right"], s["left"], n)).alias("right"),
        )

    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.left(text, half).alias("left"), F.substr(text, half + 1).alias("right"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    return F.concat(found["left"], found["right"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refilled(value: Column, chars: Column, kept: str = "[0-9]") -> Column:
    """``value`` with its digits (or what ``kept`` matches) replaced by ``chars`` in turn."""
    place = F.sequence(F.lit(1), F.length(value))

    def at(i: Column) -> Column:
        char = F.substr(value, i, F.lit(1))
        nth = F.length(F.regexp_replace(F.substr(value, F.lit(1), i), "[^" + kept[1:], ""))
        return F.when(char.rlike(kept), F.substr(chars, nth, F.lit(1))).otherwise(char)

    return F.array_join(F.transform(place, at), "")


def _luhn(digits: Column, doubled: int) -> Column:
    """Sum of digits from the right, every second one doubled, beginning with place ``doubled``."""

    def add(total: Column, i: Column) -> Column:
        d = F.substr(F.reverse(digits), i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == doubled, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _padded(number: Column, size: Column) -> Column:
    return F.lpad(number.cast("string"), size, "0")


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """Digits, at most 36 of them, that another string of as many digits has been sent to, one to one."""
    half = F.floor(F.length(digits) / 2).cast("int")
    rest = F.length(digits) - half
    left, right = F.left(digits, half), F.substr(digits, half + 1)
    size_of = lambda n: F.pow(F.lit(10.0), n).cast("long")
    found = permuted_pair(left, right, size_of(half), size_of(rest), key, kind)
    return F.concat(_padded(found["left"], half), _padded(found["right"], rest))


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    payload = permuted_digits(F.left(digits, F.length(digits) - 1), key, "card")
    check = F.pmod(10 - _luhn(payload, 1) % 10, F.lit(10)).cast("string")
    return F.when(_luhn(digits, 0) % 10 == 0, _refilled(value, F.concat(payload, check)))


def _phone(value: Column, key: str) -> Column:
    """The country code stays; seven to fourteen digits follow it."""
    code = F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    rest = F.substr(value, F.length(code) + 1)
    digits = _digits(rest)
    fits = F.length(digits).between(7, 14)
    return F.when(fits, F.concat(code, _refilled(rest, permuted_digits(digits, key, "phone"))))


def _address(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("long"))
    found = permuted_pair(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], F.lit(65536), F.lit(65536), key, "address")
    octets = [x for side in ("left", "right") for x in (F.floor(found[side] / 256), found[side] % 256)]
    plain = ~value.rlike(r"(?:^|\.)0[0-9]")
    return F.when(F.forall(parts, lambda p: p < 256) & plain, F.concat_ws(".", *[o.cast("string") for o in octets]))


def _insured(value: Column, key: str) -> Column:
    """Areas 001 to 899 but 666, groups from 01, serials from 0001."""
    area, group, serial = (F.split(value, "-")[k].cast("long") for k in range(3))
    fits = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - (area > 666).cast("long")
    found = permuted_pair(place, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, "insured")
    new_area = found["left"] + 1 + (found["left"] >= 665).cast("long")
    return F.when(fits, F.concat_ws(
        "-", _padded(new_area, F.lit(3)), _padded(F.floor(found["right"] / 9999) + 1, F.lit(2)),
        _padded(found["right"] % 9999 + 1, F.lit(4))))


def _days(first: int, second: int, *, leap: bool = False) -> str:
    """All pairs of numbers before a year that make a date, as `` 0131`` each, in order.

    The numbers are written with ``first`` and ``second`` digits and are day
    and month, or month and day; with two digits each only the pairs that must
    be month and day count. ``leap`` asks for the pairs that are dates in leap
    years alone.
    """
    months = [31, 29 if leap else 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]

    def is_date(month: int, day: int) -> bool:
        return month <= 12 and day <= months[month - 1] and (not leap or (month, day) == (2, 29))

    def fits(a: int, b: int) -> bool:
        return is_date(a, b) and b > 12 if first == second == 2 else is_date(a, b) or is_date(b, a)

    numbers = {1: range(1, 10), 2: range(1, 32)}
    return "".join(f" {a:02}{b:02}" for a in numbers[first] for b in numbers[second] if fits(a, b))


def _shaped_date(a: Column, b: Column, year: Column, mark: Column, key: str) -> Column:
    """A date of two numbers and a year, permuted among all with as many digits.

    The days that only leap years have are permuted among themselves.
    """

    def table(leap: bool) -> Column:
        chosen = F.when((F.length(a) == 2) & (F.length(b) == 2), F.lit(_days(2, 2, leap=leap)))
        for i, j in ((1, 2), (2, 1)):
            chosen = chosen.when((F.length(a) == i) & (F.length(b) == j), F.lit(_days(i, j, leap=leap)))
        return chosen.otherwise(F.lit(_days(1, 1, leap=leap)))

    pair = F.concat(F.lit(" "), F.lpad(a, 2, "0"), F.lpad(b, 2, "0"))
    every_year, leap_year = F.instr(table(False), pair), F.instr(table(True), pair)
    usual = every_year > 0
    at = F.floor((F.when(usual, every_year).otherwise(leap_year) - 1) / 5)
    days = F.when(usual, table(False)).otherwise(table(True))
    found = permuted_pair(
        F.when(usual, year - FIRST_YEAR).otherwise(F.floor((year - FIRST_LEAP) / 4)), at,
        F.when(usual, LAST_YEAR - FIRST_YEAR + 1).otherwise((LAST_LEAP - FIRST_LEAP) // 4 + 1),
        F.floor(F.length(days) / 5), key, "shaped date")
    new_year = F.when(usual, found["left"] + FIRST_YEAR).otherwise(found["left"] * 4 + FIRST_LEAP)
    place = (found["right"] * 5 + 2).cast("int")
    new_a, new_b = (F.right(F.substr(days, place + k, F.lit(2)), F.length(own)) for k, own in ((0, a), (2, b)))
    fits = F.when(usual, year.between(FIRST_YEAR, LAST_YEAR)).otherwise(
        (leap_year > 0) & (year % 4 == 0) & year.between(FIRST_LEAP, LAST_LEAP))
    return F.when(fits, F.concat(new_a, mark, new_b, mark, new_year.cast("string")))


def _date(value: Column, key: str) -> Column:
    """Year first, or day and month before it in either order; two digits each are day before month where that is a date."""
    parts = F.split(value, "[./-]")
    iso = value.rlike("^[0-9]{4}-")
    two_digits = (F.length(parts[0]) == 2) & (F.length(parts[1]) == 2)
    day_first = F.when(two_digits, F.try_to_date(F.concat_ws("-", parts[2], parts[1], parts[0])))
    day = F.when(iso, F.try_to_date(value)).otherwise(day_first)
    number = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    a, b = DAY_SIDES
    found = permuted_pair(F.floor(number / b), number % b, F.lit(a), F.lit(b), key, "date")
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), (found["left"] * b + found["right"]).cast("int"))
    mark = F.regexp_extract(value, "[./-]", 0)
    written = F.when(iso, F.date_format(new, "yyyy-MM-dd")).otherwise(
        F.concat(F.date_format(new, "dd"), mark, F.date_format(new, "MM"), mark, F.date_format(new, "yyyy")))
    shaped = F.when(~iso, _shaped_date(parts[0], parts[1], parts[2].cast("int"), mark, key))
    return F.when(day.isNull(), shaped).when(number.between(0, a * b - 1), written)


def _mod97(text: Column) -> Column:
    """Rest by 97 of a number in which letters stand for 10 to 35."""

    def add(rest: Column, char: Column) -> Column:
        at = F.instr(F.lit(LETTERS.upper()), char)
        return F.when(at > 0, (rest * 100 + at + 9) % 97).otherwise((rest * 10 + char.cast("int")) % 97)

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), add)


def _account(value: Column, key: str) -> Column:
    plain = F.regexp_replace(value, " ", "")
    country, body = F.left(plain, F.lit(2)), F.substr(plain, F.lit(5))
    fits = _mod97(F.concat(body, F.left(plain, F.lit(4)))) == 1
    new = permuted_text(body, key, "account")
    check = _padded(98 - _mod97(F.concat(new, country, F.lit("00"))), F.lit(2))
    return F.when(fits, _refilled(value, F.concat(country, check, new), "[A-Z0-9]"))


def _email(value: Column, key: str) -> Column:
    """The part before the at sign and the domain are permuted by themselves, the last label stays."""
    name, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    last = F.substring_index(domain, ".", -1)
    labels = F.left(domain, F.length(domain) - F.length(last) - 1)
    return F.concat(permuted_text(name, key, "name"), F.lit("@"), permuted_text(labels, key, "domain"), F.lit("."), last)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a found value; the value itself if it is not valid."""
    whole = lambda shape: value.rlike(f"^(?:{shape})$")
    new = (
        F.when(value.contains("@"), _email(value, key)).when(whole(DATE), _date(value, key)).when(whole(ADDRESS), _address(value, key))
        .when(whole(INSURED), _insured(value, key)).when(whole(ACCOUNT), _account(value, key))
        .when(whole(SECRET), permuted_text(value, key, "secret", "abcdef"))
        .when(whole(PHONE), _phone(value, key)).when(whole(CARD), _card(value, key))
    )
    return F.coalesce(new, value)


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with private values of ``text`` replaced, and ``n_private``, how many were.

    All rows and columns are kept, a column ``n_private`` of the input gives
    way. A null text stays null with 0 values, an empty one empty; repeated
    rows are treated alike; an empty table gives an empty result. What does
    not validate, such as a number with a wrong check digit, stays.
    """
    # Few texts hold a digit or an at sign; only these are searched.
    some = F.col("text").rlike("[0-9@]") & F.col("text").rlike(ANY)
    found = F.when(some, F.regexp_extract_all("text", F.lit(ANY), 0))
    searched = docs.select(*[F.col(c) for c in docs.columns if c != "n_private"], found.alias("__found"))
    new = searched.withColumn("__new", F.transform("__found", lambda v: pseudonym(v, key)))
    pieces = F.split("text", ANY)
    whole = F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get("__new", i), F.lit("")))), "")
    changed = F.size(F.filter(F.arrays_zip("__found", "__new"), lambda p: p["__found"] != p["__new"]))
    return new.select(
        *[F.when(F.col("__new").isNotNull(), whole).otherwise(F.col("text")).alias("text") if c == "text" else F.col(c)
          for c in docs.columns if c != "n_private"],
        F.when(F.col("__new").isNotNull(), changed).otherwise(F.lit(0)).alias("n_private"),
    )
