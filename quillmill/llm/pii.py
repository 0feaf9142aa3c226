"""Operator 3: format-preserving Feistel pseudonyms for personal data, in DataFrame functions only.

Found values are validated, then permuted within their format by a Feistel network keyed with SHA-2, so that equal
values stay equal wherever they occur and different values of a kind stay different:

- card numbers (13 to 19 digits, Luhn-valid): all digits but the last are permuted, the last is the new check digit;
- phone numbers (+ and 8 to 15 digits, in groups): the digits after the country code;
- social security numbers (ddd-dd-dddd, in the ranges that are issued): within those ranges;
- account numbers (IBAN, mod-97-valid): the part after the check digits, which are computed anew;
- dates (yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy, mm/dd/yyyy; real days of 1800 to 2199, a whole calendar cycle of
  146,097 = 189 * 773 days): the day's number within the cycle;
- IPv4 addresses (four numbers to 255): the pair of halves;
- mail addresses: letters and digits of the part before @, each within its class; hexadecimal secrets (32
  digits or more, in either case) likewise.

What fails its validation is left as it is. Separators and groups stay in place.

Edge cases: a null text stays null, an empty one empty; repeated rows give repeated rows; all other columns, whatever
their names, pass through; an empty table gives an empty one; texts of any length are read whole, with any number of
values; a value of one document never depends on another's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.expr import let

ROUNDS = 8
_MAIL = r"[\p{L}\p{N}._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}"
_PHONE = r"\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}(?![0-9])"
_IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_SECRET = r"[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])"
_DATE = r"(?:\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d\.\d\d\.\d{4}|\d\d/\d\d/\d{4})(?![0-9A-Za-z])"
_SSN = r"\d{3}-\d\d-\d{4}(?![0-9\-])"
_IP = r"\d{1,3}(?:\.\d{1,3}){3}(?![0-9]|\.[0-9])"
_CARD = r"(?:\d{4}([ \-]?)\d{4}\1\d{4}\1\d{1,7}|\d{13,19})(?![0-9])"
#: A value does not start within a run of letters and digits; kinds are tried in this order.
PATTERN = r"(?<![\p{L}\p{N}._%+\-])(?:" + _MAIL + r")|(?<![\p{L}\p{N}+])" + _PHONE + r"|(?<![\p{L}\p{N}])(?<![0-9]\.)(?:(?=[0-9A-Za-f])(?:" + "|".join((_SECRET, _DATE, _SSN, _IP, _CARD)) + ")|" + _IBAN + ")"


def _random(key: Column, kind: str, turn: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", key, F.lit(kind), turn.cast("string"), value.cast("string")), 512)


def numbers(left: Column, right: Column, a: Column, b: Column, key: Column, kind: str) -> Column:
    """Struct (l, r): the pair permuted within [0, a) x [0, b)."""

    def add(x: Column, other: Column, turn: Column, size: Column) -> Column:
        return F.pmod(x + F.conv(F.substring(_random(key, kind, turn, other), 1, 13), 16, 10).cast("bigint"), size)

    def turn(s: Column, t: Column) -> Column:
        odd = t % 2 == 1
        return F.struct(F.when(odd, add(s.l, s.r, t, a)).otherwise(s.l).alias("l"), F.when(odd, s.r).otherwise(add(s.r, s.l, t, b)).alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r")), turn)


def digits(value: Column, key: Column, kind: str) -> Column:
    """A string of 2 to 18 digits permuted among those of its length."""

    def halves(v: Column) -> Column:
        n = F.length(v)
        h = F.floor(n / 2).cast("int")
        a, b = (F.pow(F.lit(10.0), x).cast("bigint") for x in (h, n - h))
        done = numbers(v.substr(F.lit(1), h).try_cast("bigint"), v.substr(h + 1, n).try_cast("bigint"), a, b, key, kind)
        return let(done, lambda s: F.concat(F.lpad(s.l.cast("string"), h, "0"), F.lpad(s.r.cast("string"), n - h, "0")))

    return let(value, halves)


def characters(value: Column, key: Column, kind: str, letters: int = 26) -> Column:
    """A string with each digit and ASCII letter permuted within its class (letters: how many of the alphabet)."""

    def shift(c: Column, by: Column) -> Column:
        out = c
        for first, size in ((48, 10), (65, letters), (97, letters)):
            out = F.when(F.ascii(c).between(first, first + size - 1), F.char(F.pmod(F.ascii(c) - first + by, F.lit(size)) + first)).otherwise(out)
        return out

    def add(x: Column, other: Column, turn: Column) -> Column:
        def stream(r: Column) -> Column:
            moved = F.transform(F.split(x, ""), lambda c, i: shift(c, F.conv(F.substr(r, F.pmod(i * 2, F.lit(126)) + 1, F.lit(2)), 16, 10).cast("int")))
            return F.array_join(moved, "")

        return F.when(x == "", x).otherwise(let(_random(key, kind, turn, other), stream))

    def turn(s: Column, t: Column) -> Column:
        odd = t % 2 == 1
        return F.struct(F.when(odd, add(s.l, s.r, t)).otherwise(s.l).alias("l"), F.when(odd, s.r).otherwise(add(s.r, s.l, t)).alias("r"))

    def halves(v: Column) -> Column:
        h = F.floor(F.length(v) / 2).cast("int")
        start = F.struct(v.substr(F.lit(1), h).alias("l"), v.substr(h + 1, F.length(v)).alias("r"))
        return let(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn), lambda s: F.concat(s.l, s.r))

    return let(value, halves)


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def refill(value: Column, filling: Column) -> Column:
    """value with its digits and capitals replaced by the characters of filling, in order; other characters stay."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    done = F.aggregate(
        F.split(value, ""),
        start,
        lambda s, c: F.when(c.rlike("^[0-9A-Z]$"), F.struct(F.concat(s.out, F.substr(filling, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(s.out, c).alias("out"), s["at"].alias("at"))),
    )
    return done.out


def luhn_digit(payload: Column) -> Column:
    """Check digit that makes payload Luhn-valid, as text."""
    places = F.transform(F.split(F.reverse(payload), ""), lambda c, i: let(F.coalesce(c.try_cast("int"), F.lit(0)) * F.when(i % 2 == 0, 2).otherwise(1), lambda d: F.when(d > 9, d - 9).otherwise(d)))
    return F.pmod(10 - F.aggregate(places, F.lit(0), lambda a, d: a + d) % 10, F.lit(10)).cast("string")


def card(value: Column, key: Column) -> Column:
    def one(d: Column) -> Column:
        payload = d.substr(F.lit(1), F.length(d) - 1)
        valid = F.length(d).between(13, 19) & (luhn_digit(payload) == F.right(d, F.lit(1)))
        return F.when(valid, let(digits(payload, key, "card"), lambda p: refill(value, F.concat(p, luhn_digit(p))))).otherwise(value)

    return let(only_digits(value), one)


def phone(value: Column, key: Column) -> Column:
    lead = F.regexp_extract(value, r"^\+(?:1|\d{1,3}?(?=[ .\-(])|\d{2})", 0)

    def one(code: Column) -> Column:
        rest = value.substr(F.length(code) + 1, F.length(value))
        return let(only_digits(rest), lambda d: F.when(F.length(d).between(7, 14), F.concat(code, refill(rest, digits(d, key, "phone")))).otherwise(value))

    return let(lead, one)


def ssn(value: Column, key: Column) -> Column:
    area, group, serial = (value.substr(i, n).try_cast("bigint") for i, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    done = numbers(area - F.when(area > 666, 2).otherwise(1), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, "ssn")
    text = let(done, lambda s: F.concat_ws("-", *(F.lpad(x.cast("bigint").cast("string"), n, "0") for x, n in ((s.l + F.when(s.l >= 665, 2).otherwise(1), 3), (F.floor(s.r / 9999) + 1, 2), (s.r % 9999 + 1, 4)))))
    return F.when(valid, text).otherwise(value)


def mod97(value: Column) -> Column:
    """Remainder of an IBAN's rearranged characters, letters as 10 to 35."""
    return F.aggregate(
        F.split(value, ""),
        F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.try_cast("int")) % 97).when(c.rlike("[A-Z]"), (a * 100 + F.ascii(c) - 55) % 97).otherwise(a),
    )


def iban(value: Column, key: Column) -> Column:
    def one(v: Column) -> Column:
        country, rest = v.substr(1, 2), v.substr(F.lit(5), F.length(v))
        valid = F.length(v).between(15, 34) & (mod97(F.concat(rest, v.substr(1, 4))) == 1)

        def new(r: Column) -> Column:
            check = F.lpad((98 - mod97(F.concat(r, country, F.lit("00")))).cast("string"), 2, "0")
            return refill(value, F.concat(country, check, r))

        return F.when(valid, let(characters(rest, key, "iban"), new)).otherwise(value)

    return let(F.replace(value, F.lit(" "), F.lit("")), one)


def date(value: Column, key: Column) -> Column:
    style = F.when(value.rlike(r"^\d{4}-"), "yyyy-MM-dd").when(value.rlike(r"^\d{4}/"), "yyyy/MM/dd").when(F.contains(value, F.lit(".")), "dd.MM.yyyy").otherwise("MM/dd/yyyy")
    part = let(F.regexp_extract_all(value, F.lit(r"(\d+)"), 1), lambda p: F.when(style.startswith("y"), F.concat_ws("-", p)).when(style.startswith("d"), F.concat_ws("-", F.get(p, F.lit(2)), F.get(p, F.lit(1)), F.get(p, F.lit(0)))).otherwise(F.concat_ws("-", F.get(p, F.lit(2)), F.get(p, F.lit(0)), F.get(p, F.lit(1)))))
    day = part.try_cast("date")
    origin = F.lit("1800-01-01").cast("date")

    def new(n: Column) -> Column:
        moved = let(numbers(F.floor(n / 773), n % 773, F.lit(189), F.lit(773), key, "date"), lambda s: F.date_add(origin, (s.l * 773 + s.r).cast("int")))
        return let(moved, lambda d: F.when(style == "yyyy-MM-dd", F.date_format(d, "yyyy-MM-dd")).when(style == "yyyy/MM/dd", F.date_format(d, "yyyy/MM/dd")).when(style == "dd.MM.yyyy", F.date_format(d, "dd.MM.yyyy")).otherwise(F.date_format(d, "MM/dd/yyyy")))

    return let(F.datediff(day, origin), lambda n: F.when(n.between(0, 189 * 773 - 1), new(n)).otherwise(value))


def ip(value: Column, key: Column) -> Column:
    def one(p: Column) -> Column:
        o = [F.get(p, F.lit(i)).try_cast("bigint") for i in range(4)]
        plain = F.array_join(F.transform(p, lambda x: x.try_cast("bigint").cast("string")), ".") == value  # no leading zeros: else two texts would have one image
        done = numbers(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, "ip")
        text = let(done, lambda s: F.concat_ws(".", *(x.cast("bigint").cast("string") for x in (F.floor(s.l / 256), s.l % 256, F.floor(s.r / 256), s.r % 256))))
        return F.when(plain & (F.greatest(*o) <= 255), text).otherwise(value)

    return let(F.split(value, r"\."), one)


def mail(value: Column, key: Column) -> Column:
    return F.concat(characters(F.substring_index(value, "@", 1), key, "mail"), F.lit("@"), F.substring_index(value, "@", -1))


def pseudonym(value: Column, key: Column) -> Column:
    """The pseudonym of one found value; the value itself where it is not valid."""
    return (
        F.when(F.contains(value, F.lit("@")), mail(value, key))
        .when(value.startswith("+"), phone(value, key))
        .when(value.rlike(f"^{_SECRET}$") & value.rlike("[A-Fa-f]"), characters(value, key, "secret", 6))
        .when(value.rlike("^[A-Z]"), iban(value, key))
        .when(value.rlike(f"^{_DATE}$"), date(value, key))
        .when(value.rlike(f"^{_SSN}$"), ssn(value, key))
        .when(value.rlike(r"^[0-9]{1,3}\..*\."), ip(value, key))
        .otherwise(card(value, key))
    )


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """docs with the personal data of text_col replaced; count_col, if given, gets the number of replaced values."""
    text, secret = F.col(f"`{text_col}`").cast("string"), F.lit(key)
    found = F.regexp_extract_all(text, F.lit(PATTERN), 0)

    def rebuild(new: Column) -> Column:
        return F.array_join(F.zip_with(F.split(text, PATTERN, -1), F.concat(new.new, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")

    def both(old: Column) -> Column:
        return F.struct(old.alias("old"), F.transform(old, lambda m: pseudonym(m, secret)).alias("new"))

    result = let(let(found, both), lambda x: F.struct(rebuild(x).alias("text"), F.size(F.filter(F.zip_with(x.old, x.new, lambda a, b: a != b), lambda c: c)).cast("long").alias("n")))
    hit = text.rlike(PATTERN)
    empty = F.struct(text.alias("text"), F.lit(0).cast("long").alias("n"))
    name = "__pii__"
    while name.lower() in {c.lower() for c in [*docs.columns, count_col or ""]}:
        name += "_"
    out = docs.withColumn(name, F.when(hit, result).otherwise(empty))
    out = out.withColumn(text_col, F.col(f"`{name}`.text"))
    return (out.withColumn(count_col, F.col(f"`{name}`.n")) if count_col else out).drop(name)
