"""Format-preserving pseudonyms for personal data (native columns only).

Found in a text and checked: payment card numbers (13 to 19 digits with a
valid check digit), phone numbers with a country or area code, social security
numbers (valid ranges), IPv4 addresses (four octets), calendar dates
(yyyy-mm-dd, dd/mm/yyyy or dd.mm.yyyy that exist, 1900 to 2099), e-mail
addresses and long hexadecimal secrets (32 to 64 digits).  What fails its check
stays as it is.

Numbers and dates are permuted by a keyed Feistel network within their format:
the digits are cut into two halves, and in each round one half is shifted,
modulo its size, by a keyed digest of the other.  This is a bijection of the
format, so equal values get equal pseudonyms in all documents and different
values different ones.  Separators stay.  A card keeps a valid check digit (its
other digits are permuted).  A date is permuted as a day number, walking the
cycle until it is inside the range.  An address is a 32-bit number of two
halves.  Mail addresses and secrets are no numbers: they become a keyed digest
in their own format (ten characters at example.invalid; hexadecimal digits of
the same length and case).

A text is split at the matches of one pattern and put together again, so a
whole text of any length is one expression without Python.  Null stays null;
empty and clean texts stay unchanged.  Rows are independent, other columns
pass unchanged.  The key is a parameter; who holds it can link values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import let

ROUNDS = 8
_B = r"(?<![A-Za-z0-9_])"
_E = r"(?![A-Za-z0-9_])"
MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}"
SECRET = _B + r"(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})" + _E
ADDRESS = r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])"
DATE = r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z]|[./-][0-9])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])"
PHONE = (r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
         r"|\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,4}(?![0-9]|\.[0-9])"
         r"|(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9]|-[0-9])")
CARD = (_B + r"(?:[0-9]{13,19}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}"
        r"|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{4}-[0-9]{6}-[0-9]{5})" + _E)
PATTERN = "|".join([MAIL, SECRET, ADDRESS, DATE, SSN, CARD, PHONE])
#: cheap test that comes first: no match without one of these
QUICK = r"@|[0-9][0-9 ().+/-]{5,}[0-9]|[0-9A-Fa-f]{32}"
KINDS = ("mail", "secret", "address", "date", "ssn", "card", "phone")
FIRST_DAY, DAYS = "1900-01-01", 73_049          # to 2099-12-31


def _digest(key: str, salt: str, i: Column, x: Column) -> Column:
    """60 keyed bits as a long."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(salt), i.cast("string"), x.cast("string")),
                                     256), 1, 15), 16, 10).cast("long")


def _feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, salt: str) -> Column:
    """Struct (a, b): the pair after ROUNDS rounds, a below size_a, b below size_b."""
    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        other = F.when(even, s["b"]).otherwise(s["a"])
        d = _digest(key, salt, i, other)
        return F.struct(F.when(even, (s["a"] + d % size_a) % size_a).otherwise(s["a"]).alias("a"),
                        F.when(even, s["b"]).otherwise((s["b"] + d % size_b) % size_b).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
                       F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)


def permute_digits(digits: Column, key: str, salt: str) -> Column:
    """The digit string permuted among those of its length (2 to 36)."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    size = [F.rpad(F.lit("1"), k + 1, "0").cast("long") for k in (half, n - half)]
    pair = _feistel(F.substring(digits, F.lit(1), half), F.substring(digits, half + 1, n - half), *size, key, salt)
    return let(pair, lambda p: F.concat(F.lpad(p["a"].cast("string"), half, "0"),
                                        F.lpad(p["b"].cast("string"), n - half, "0")))


def _only_digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _into(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced, in order, by those of ``digits``."""
    chars = F.transform(F.sequence(F.lit(1), F.length(m)), lambda i: F.when(
        F.substring(m, i, F.lit(1)).rlike("[0-9]"),
        F.substring(digits, F.length(_only_digits(F.substring(m, F.lit(1), i))), F.lit(1)))
        .otherwise(F.substring(m, i, F.lit(1))))
    return F.array_join(chars, "")


def luhn_sum(digits: Column) -> Column:
    """Sum of the check rule over a digit string (valid: a multiple of 10)."""
    def add(s: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = d * 2
        return s + F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _card(m: Column, key: str) -> Column:
    def build(d: Column) -> Column:
        body = permute_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, "card")
        return let(body, lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
    return F.when(luhn_sum(_only_digits(m)) % 10 == 0, let(build(_only_digits(m)), lambda d: _into(m, d))).otherwise(m)


def _address(m: Column, key: str) -> Column:
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))

    def build(o: Column) -> Column:
        pair = _feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, "address")
        return let(pair, lambda p: F.concat_ws(".", *[x.cast("string") for x in (
            F.floor(p["a"] / 256), p["a"] % 256, F.floor(p["b"] / 256), p["b"] % 256)]))
    return let(o, lambda o: F.when(F.array_max(o) <= 255, build(o)).otherwise(m))


def _date(m: Column, key: str) -> Column:
    iso = m.rlike("^[0-9]{4}-")
    slash = m.contains("/")
    day = F.when(iso, F.try_to_date(m, "yyyy-MM-dd")).when(slash, F.try_to_date(m, "dd/MM/yyyy")).otherwise(
        F.try_to_date(m, "dd.MM.yyyy"))
    number = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
    side = 271                                   # 271^2 is just above the number of days

    def walk(n: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            pair = _feistel(F.floor(s["n"] / side), s["n"] % side, F.lit(side), F.lit(side), key, "date")
            nxt = let(pair, lambda p: p["a"] * side + p["b"])
            return F.when(s["done"], s).otherwise(let(nxt, lambda x: F.struct(x.alias("n"), (x < DAYS).alias("done"))))
        start = F.struct(n.alias("n"), F.lit(False).alias("done"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(12)), start, step)["n"]

    def write(n: Column) -> Column:
        d = F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int"))
        return F.when(iso, F.date_format(d, "yyyy-MM-dd")).when(slash, F.date_format(d, "dd/MM/yyyy")).otherwise(
            F.date_format(d, "dd.MM.yyyy"))
    return let(number, lambda n: F.when((n >= 0) & (n < DAYS), let(walk(n), write)).otherwise(m))


def _ssn(m: Column, key: str) -> Column:
    valid = ~m.rlike("^(000|666|9[0-9]{2})|-00-|-0000$")
    return F.when(valid, let(permute_digits(_only_digits(m), key, "ssn"), lambda d: _into(m, d))).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    """The country code stays, the national digits are permuted."""
    lead = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])", 0)

    def build(rest: Column) -> Column:
        return F.concat(lead, let(permute_digits(_only_digits(rest), key, "phone"), lambda d: _into(rest, d)))
    return let(F.substring(m, F.length(lead) + 1, F.length(m)), lambda r: F.when(
        F.length(_only_digits(r)).between(7, 15), build(r)).otherwise(m))


def _mail(m: Column, key: str) -> Column:
    return F.concat(F.substring(F.sha2(F.concat(F.lit(key + "|mail|"), F.lower(m)), 256), 1, 10),
                    F.lit("@example.invalid"))


def _secret(m: Column, key: str) -> Column:
    d = F.substring(F.sha2(F.concat(F.lit(key + "|secret|"), F.lower(m)), 256), F.lit(1), F.length(m))
    return F.when(m.rlike("[A-F]"), F.upper(d)).otherwise(d)


def pseudonym(m: Column, key: str) -> Column:
    """The replacement of one match (the match itself where its check fails)."""
    n = F.length(_only_digits(m))
    return (F.when(m.contains("@"), _mail(m, key))
            .when(m.rlike("^[0-9A-Fa-f]{32,64}$"), _secret(m, key))
            .when(m.rlike(f"^(?:{ADDRESS})$"), _address(m, key))
            .when(m.rlike(f"^(?:{DATE})$"), _date(m, key))
            .when(m.rlike(f"^(?:{SSN})$"), _ssn(m, key))
            .when(m.rlike(f"^(?:{CARD})$") & (n >= 13), _card(m, key))
            .otherwise(_phone(m, key)))


def pseudonymised(text: Column, key: str) -> Column:
    """Struct (text, n): the text with pseudonyms and how many values changed."""
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))

    def build(old: Column) -> Column:
        def join(new: Column) -> Column:
            pieces = F.zip_with(F.split(text, PATTERN, -1), new, lambda p, m: F.concat(p, F.coalesce(m, F.lit(""))))
            changed = F.size(F.filter(F.zip_with(old, new, lambda a, b: a != b), lambda x: x))
            return F.struct(F.array_join(pieces, "").alias("text"), changed.cast("long").alias("n"))
        return let(F.transform(old, lambda m: pseudonym(m, key)), join)

    same = F.struct(text.alias("text"), F.lit(0).cast("long").alias("n"))
    return F.when(text.rlike(QUICK), let(found, lambda m: F.when(F.size(m) > 0, build(m)).otherwise(same))).otherwise(same)


def pseudonymise(docs: DataFrame, text_col: str = "text", key: str = "tillpoint", count_col: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col`` (and the number of changed
    values in ``count_col``, if named)."""
    d = docs.withColumn("__p", pseudonymised(F.col(text_col), key))
    cols = [F.col("__p.text").alias(c) if c == text_col else F.col(c) for c in docs.columns]
    return d.select(*cols, *([F.col("__p.n").alias(count_col)] if count_col else []))
