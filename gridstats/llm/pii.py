"""Format-preserving pseudonyms for personal data in texts, by a keyed Feistel permutation.

Found and validated: e-mail addresses, IPv4 addresses, North American telephone numbers, social security numbers,
payment card numbers (check digit) and calendar dates. Telephone numbers that no area could have are found too when
a country code or brackets mark them, and are permuted among themselves. Each value is a number below m0 * m1, split into two halves that
eight rounds add keyed hashes of each other to. That permutes the values of a kind among themselves: the format and
validity stay, equal values become equal pseudonyms in all documents whatever their punctuation, different values stay
different, and the key undoes it. What does not validate stays as it is.

Everything is column expressions over the row: no exchange, no Python.
"""

from __future__ import annotations

import hashlib
from calendar import monthrange

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.functions.binding import let
from gridstats.llm.columns import unused

ROUNDS = 8
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])"
IPV4 = r"(?<![A-Za-z0-9.])\d{1,3}(?:\.\d{1,3}){3}(?![A-Za-z0-9]|\.\d)"
PHONE = r"(?<![A-Za-z0-9+])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![A-Za-z0-9])"
SSN = r"(?<![A-Za-z0-9-])\d{3}-\d{2}-\d{4}(?![A-Za-z0-9-])"
DATE = r"(?<![A-Za-z0-9])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![A-Za-z0-9])"
# A run of digits that holds a telephone number of its own is no card.
CARD = r"(?<![A-Za-z0-9])(?!(?:\d[ -]?){0,16}(?<!\d)\d{3}[ -]\d{3}[ -]\d{4}(?!\d))\d(?:[ -]?\d){12,18}(?![A-Za-z0-9])"
ANY = "|".join([EMAIL, IPV4, SSN, DATE, CARD, PHONE])
# Dates are permuted by year and place in the year, days above 12 apart from the others; the leap days from 1904 to 2096.
FIRST_YEAR, YEARS, LEAPS = 1900, 200, (7, 7)
LATE_DAYS = tuple(f"{day:02d}/{month:02d}" for month in range(1, 13) for day in range(13, monthrange(2023, month)[1] + 1))


def secret_of(key: str) -> str:
    """What the expressions hold in place of the key, so that the key itself is in no plan."""
    return hashlib.sha256(f"pseudonyms:{key}".encode()).hexdigest()


def feistel(left: Column, right: Column, m0: Column, m1: Column, kind: Column, secret: str, undo: bool) -> Column:
    """Struct (l, r): the permuted halves of a value, l below ``m0`` and r below ``m1``."""

    def noise(i: Column, half: Column, modulus: Column) -> Column:
        text = F.concat_ws("|", F.lit(secret), kind, i.cast("string"), half.cast("string"))
        drawn = F.pmod(F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 14), 16, 10).cast("long"), modulus)
        return -drawn if undo else drawn

    def step(state: Column, i: Column) -> Column:
        low, high, even = state["l"], state["r"], i % 2 == 0
        new_low = F.when(even, F.pmod(low + noise(i, high, m0), m0)).otherwise(low)
        new_high = F.when(even, high).otherwise(F.pmod(high + noise(i, low, m1), m1))
        return F.struct(new_low.alias("l"), new_high.alias("r"))

    rounds = list(range(ROUNDS))[:: -1 if undo else 1]
    begin = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.array(*[F.lit(i) for i in rounds]), begin, step)


def power(base: int, exponent: Column) -> Column:
    return F.pow(F.lit(float(base)), exponent).cast("long")


LATIN, BASE26 = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdefghijklmnop"


def permuted_text(text: Column, letters: bool, kind: str, secret: str, undo: bool) -> Column:
    """A string of lower-case letters or of digits, permuted among those of its length; 20 characters at a time."""
    base = 26 if letters else 10
    read = (lambda c: F.translate(c, LATIN, BASE26)) if letters else (lambda c: c)
    write = (lambda c: F.translate(c, BASE26, LATIN)) if letters else (lambda c: c)

    def number(c: Column) -> Column:
        return F.coalesce(F.conv(F.concat(F.lit("0"), read(c)), base, 10).try_cast("long"), F.lit(0).cast("long"))

    def part(seg: Column, k: Column) -> Column:
        n = F.length(seg)
        u = F.floor(n / 2).cast("int")
        tweak = F.concat_ws(":", F.lit(kind), k.cast("string"), n.cast("string"))
        halves = feistel(number(F.substring(seg, F.lit(1), u)), number(F.substring(seg, u + 1, n - u)), power(base, u), power(base, n - u), tweak, secret, undo)
        digits = lambda value, width: F.lpad(F.lower(F.conv(value.cast("string"), 10, base)), width, F.lit("0"))
        return let(halves, lambda h: write(F.concat(F.when(u > 0, digits(h["l"], u)).otherwise(""), digits(h["r"], n - u))))

    segments = F.transform(F.sequence(F.lit(0), F.floor((F.length(text) - 1) / 20).cast("int")), lambda k: part(F.substring(text, k * 20 + 1, F.lit(20)), k))
    return F.when(F.length(text) > 0, F.array_join(segments, "")).otherwise("")


def only(text: Column, kept: str) -> Column:
    return F.regexp_replace(text, f"[^{kept}]", "")


def filled(text: Column, digits: Column, letters: Column | None = None) -> Column:
    """``text`` with its digits, and if given its letters in their case, replaced in order."""

    def one(c: Column, i: Column) -> Column:
        before = F.substring(text, F.lit(1), i + 1)
        value = F.when(c.rlike("^[0-9]$"), F.substring(digits, F.length(only(before, "0-9")), F.lit(1)))
        if letters is not None:
            letter = F.substring(letters, F.length(only(before, "A-Za-z")), F.lit(1))
            value = value.when(c.rlike("^[a-z]$"), letter).when(c.rlike("^[A-Z]$"), F.upper(letter))
        return value.otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def luhn(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled; a card number's sum ends in 0."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n + 1 - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def whole(text: Column, first: int, size: int) -> Column:
    return F.substring(text, first, size).cast("long")


def email(m: Column, secret: str, undo: bool) -> Column:
    def local(name: Column) -> Column:
        digits = permuted_text(only(name, "0-9"), False, "email-digits", secret, undo)
        letters = permuted_text(F.lower(only(name, "A-Za-z")), True, "email-letters", secret, undo)
        return let(F.struct(digits.alias("d"), letters.alias("l")), lambda x: filled(name, x["d"], x["l"]))

    return F.concat(local(F.substring_index(m, "@", 1)), F.lit("@"), F.substring_index(m, "@", -1))


def ipv4(m: Column, secret: str, undo: bool) -> Column:
    octet = F.transform(F.split(m, r"\."), lambda c: c.cast("int"))

    def change(o: Column) -> Column:
        size = F.lit(65536).cast("long")
        halves = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], size, size, F.lit("ipv4"), secret, undo)
        parts = lambda h: F.concat_ws(".", *[x.cast("string") for v in (h["l"], h["r"]) for x in (F.shiftright(v, 8), F.pmod(v, F.lit(256)))])
        return F.when(F.array_max(o) < 256, let(halves, parts))

    return let(octet, change)


def phone(m: Column, secret: str, undo: bool) -> Column:
    def change(d: Column) -> Column:
        area, exchange = whole(d, 1, 3), whole(d, 4, 3)
        # codes below 200 are permuted among themselves, each half with those of its own kind
        least = lambda code: F.when(code < 200, 0).otherwise(200)
        size = lambda code: F.when(code < 200, 20_000).otherwise(80_000).cast("long")
        kind = F.when((area >= 200) & (exchange >= 200), "phone").otherwise(F.concat_ws(":", F.lit("phone"), least(area).cast("string"), least(exchange).cast("string")))
        halves = feistel((area - least(area)) * 100 + whole(d, 7, 2), (exchange - least(exchange)) * 100 + whole(d, 9, 2), size(area), size(exchange), kind, secret, undo)
        text = lambda v, tail: F.lpad(v.cast("string"), 3 if not tail else 2, "0")
        number = lambda h: F.concat(
            text(F.floor(h["l"] / 100) + least(area), False), text(F.floor(h["r"] / 100) + least(exchange), False), text(F.pmod(h["l"], F.lit(100)), True), text(F.pmod(h["r"], F.lit(100)), True)
        )
        country = F.when(F.length(only(m, "0-9")) == 11, F.lit("1")).otherwise("")
        # ten bare digits that begin below 200 are no telephone number
        marked = m.contains("(") | (F.length(only(m, "0-9")) == 11)
        return F.when((area >= 200) | marked, let(let(halves, number), lambda x: filled(m, F.concat(country, x))))

    return let(F.substring(only(m, "0-9"), -10, 10), change)


def ssn(m: Column, secret: str, undo: bool) -> Column:
    def change(d: Column) -> Column:
        area, group, serial = whole(d, 1, 3), whole(d, 4, 2), whole(d, 6, 4)
        valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
        place = F.when(area > 666, area - 2).otherwise(area - 1)
        halves = feistel(place, (group - 1) * 9999 + serial - 1, F.lit(898).cast("long"), F.lit(99 * 9999).cast("long"), F.lit("ssn"), secret, undo)

        def number(h: Column) -> Column:
            back = F.when(h["l"] >= 665, h["l"] + 2).otherwise(h["l"] + 1)
            return F.format_string("%03d-%02d-%04d", back, F.floor(h["r"] / 9999) + 1, F.pmod(h["r"], F.lit(9999)) + 1)

        return F.when(valid, let(halves, number))

    return let(only(m, "0-9"), change)


def date(m: Column, secret: str, undo: bool) -> Column:
    """A calendar date: days above 12 are permuted among themselves, the others too, and leap days as well, by year and place
    in the year. So every form of one date becomes a form of one other, and a slashed date stays readable as it was."""
    size = lambda n: F.lit(n).cast("long")
    places = F.array(*[F.lit(d) for d in LATE_DAYS])
    year_first = m.rlike(r"^\d{4}[-/]")
    day_first = m.contains(".") | m.rlike(r"^(1[3-9]|[23]\d)/")
    numbers = F.when(year_first, F.struct(F.substring(m, 9, 2).alias("d"), F.substring(m, 6, 2).alias("m"), F.substring(m, 1, 4).alias("y")))
    numbers = numbers.when(day_first, F.struct(F.substring(m, 1, 2).alias("d"), F.substring(m, 4, 2).alias("m"), F.substring(m, 7, 4).alias("y")))
    numbers = numbers.otherwise(F.struct(F.substring(m, 4, 2).alias("d"), F.substring(m, 1, 2).alias("m"), F.substring(m, 7, 4).alias("y")))

    def written(new: Column) -> Column:
        """``new``: year and dd/MM."""
        day, month, year = F.substring(new["p"], 1, 2), F.substring(new["p"], 4, 2), new["y"].cast("string")
        sep = F.when(year_first, F.substring(m, 5, 1)).otherwise(F.substring(m, 3, 1))
        return F.when(year_first, F.concat(year, sep, month, sep, day)).when(day_first, F.concat(day, sep, month, sep, year)).otherwise(F.concat(month, sep, day, sep, year))

    def result(halves: Column, year, place) -> Column:
        return let(let(halves, lambda h: F.struct(year(h).alias("y"), place(h).alias("p"))), written)

    def change(x: Column) -> Column:
        day, month, year = x["d"].cast("int"), x["m"].cast("int"), x["y"].cast("long")
        own = F.array_position(places, F.concat(x["d"], F.lit("/"), x["m"])) - 1
        late = feistel(year - FIRST_YEAR, own, size(YEARS), size(len(LATE_DAYS)), F.lit("date:late"), secret, undo)
        early = feistel(year - FIRST_YEAR, (month - 1) * 12 + day - 1, size(YEARS), size(144), F.lit("date:early"), secret, undo)
        leap = F.floor((year - 1904) / 4)
        leaping = feistel(F.floor(leap / LEAPS[1]), F.pmod(leap, F.lit(LEAPS[1])), size(LEAPS[0]), size(LEAPS[1]), F.lit("date:leap"), secret, undo)
        known = (year >= FIRST_YEAR) & (year < FIRST_YEAR + YEARS) & month.between(1, 12)
        common = lambda h: h["l"] + FIRST_YEAR
        of_early = lambda h: F.format_string("%02d/%02d", F.pmod(h["r"], F.lit(12)) + 1, F.floor(h["r"] / 12) + 1)
        return (
            F.when(known & day.between(1, 12), result(early, common, of_early))
            .when(known & (own >= 0), result(late, common, lambda h: F.get(places, h["r"].cast("int"))))
            .when(known & (day == 29) & (month == 2) & (year % 4 == 0) & (year > FIRST_YEAR), result(leaping, lambda h: 1904 + 4 * (h["l"] * LEAPS[1] + h["r"]), lambda h: F.lit("29/02")))
        )

    return let(numbers, change)


def card(m: Column, secret: str, undo: bool) -> Column:
    def change(d: Column) -> Column:
        n = F.length(d) - 1
        u = F.floor(n / 2).cast("int")
        left, right = F.substring(d, F.lit(1), u).cast("long"), F.substring(d, u + 1, n - u).cast("long")
        halves = feistel(left, right, power(10, u), power(10, n - u), F.concat(F.lit("card:"), n.cast("string")), secret, undo)
        body = lambda h: F.concat(F.lpad(h["l"].cast("string"), u, F.lit("0")), F.lpad(h["r"].cast("string"), n - u, F.lit("0")))
        checked = lambda b: F.concat(b, F.pmod(10 - F.pmod(luhn(F.concat(b, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string"))
        return F.when(luhn(d) % 10 == 0, let(let(let(halves, body), checked), lambda x: filled(m, x)))

    return let(only(m, "0-9"), change)


def pseudonym(m: Column, secret: str, undo: bool = False) -> Column:
    """The pseudonym of a found value, or null where it does not validate."""
    return (
        F.when(m.contains("@"), email(m, secret, undo))
        .when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), ipv4(m, secret, undo))
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), ssn(m, secret, undo))
        .when(m.rlike(r"^(\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})$"), date(m, secret, undo))
        .when(F.length(only(m, "0-9")) >= 13, card(m, secret, undo))
        .otherwise(phone(m, secret, undo))
    )


def pseudonymise(docs: DataFrame, key: str, text: str = "text", count: str | None = None, undo: bool = False, left: str | None = None) -> DataFrame:
    """``docs`` with the personal data of ``text`` replaced; ``count`` names a column for the number of replaced values.

    A null text stays null with count 0, an empty one empty; texts are searched whole, however long. Dates outside of 1900 to
    2099 and values that do not validate stay; ``left`` names a column for the list of those found and left. ``undo`` with the same key
    gives the texts back. Columns keep their order; columns named as ``count`` or ``left`` are replaced.
    """
    secret = secret_of(key)
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))

    def rebuilt(new: Column, old: Column) -> Column:
        pieces = F.split(F.col(text), ANY)
        joined = F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(new, i), F.get(old, i), F.lit("")))), "")
        values = [joined.alias("t"), F.size(F.filter(new, lambda x: x.isNotNull())).alias("n")]
        return F.struct(*values, *([F.filter(old, lambda x, i: F.get(new, i).isNull()).alias("s")] if left else []))

    replaced = let(found, lambda old: let(F.transform(old, lambda m: pseudonym(m, secret, undo)), lambda new: rebuilt(new, old)))
    done = F.when(F.col(text).rlike("[0-9@]"), replaced).otherwise(F.struct(F.col(text).alias("t"), F.lit(0).alias("n"), *([F.array().cast("array<string>").alias("s")] if left else [])))
    place = unused(docs, "done")
    result = docs.withColumn(place, done)
    columns = [F.col(f"{place}.t").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c not in (count, left)]
    added = [F.col(f"{place}.{field}").alias(c) for field, c in (("n", count), ("s", left)) if c]
    return result.select(*columns, *added)
