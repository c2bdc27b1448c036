"""PII: format-preserving Feistel pseudonyms, in DataFrame operations.

One pattern finds candidates; each is validated by its kind and replaced by a
keyed permutation of its own value space, written in the same format:

* card: 13 to 19 digits in one run, or in groups of 4-4-4-rest or 4-6-5 between
  blanks or hyphens, that pass the Luhn check; the digits but the last are permuted, the last is the new check digit;
* phone: +1 (area) exchange-line with any digits: the area and the rest are
  permuted together; those under 200 and the others each stay among themselves;
* ssn: area-group-serial with area 001-899 but 666, group 01-99, serial 0001-9999;
* ip: four numbers up to 255, permuted as one 32-bit number;
* date: a real day from 1900 to 2099, as 2001-02-28, 28.02.2001 or 28/02/2001.

A value (x, y) with x < a and y < b goes through alternating Feistel rounds
x = (x + F(key, round, y)) mod a and y = (y + F(key, round, x)) mod b, which
undo each other, so equal values get equal pseudonyms in every document and
different values of a kind different ones. E-mail addresses are not numbers:
they get a keyed digest of the lower-cased address.

Candidates that do not validate stay as they are. A null text stays null, an
empty one empty. Repeated rows get equal results, rows without an id are
treated like others, an empty table gives an empty result. Only the id and the
text are read. All work is on single rows: no shuffle, and a hot value costs
nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "pseudonym-key-1"
ROUNDS = 10
# The pattern of each kind, whole candidates only.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,24}",
    "phone": r"(?<![0-9+])\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9])",
    "date": r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2})(?![0-9/-]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "ip": r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
}
KINDS = tuple(PATTERNS)
ANY = "|".join(PATTERNS.values())
#: What a text must have for any kind: an at sign, or a digit within reach of four more.
NEEDS = r"@|[0-9][-0-9 ./()+]{5}"
#: Days of 1900 to 2099; 17 * 4297 of them.
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)


def feistel(x: Column, y: Column, a: Column | int, b: Column | int, kind: str, key: str) -> Column:
    """struct(x, y) permuted within x < a and y < b (longs)."""
    a, b = (F.lit(v).cast("long") if isinstance(v, int) else v.cast("long") for v in (a, b))

    def half(r: Column, value: Column) -> Column:
        return F.pmod(F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(key), F.lit(kind), r, a, b, value), 256), 1, 14), 16, 10).cast("long"),
                      F.lit(1 << 52))

    def step(acc, r):
        left = F.pmod(acc["x"] + half(r * 2, acc["y"]), a)
        return F.struct(left.alias("x"), F.pmod(acc["y"] + half(r * 2 + 1, left), b).alias("y"))

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), start, step)


def _let(value: Column, use) -> Column:
    """use(value) with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _digits(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string without its check digit."""
    def weigh(c, k):
        n = c.cast("int")
        twice = n * 2
        return F.when(k % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(n)
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), weigh), F.lit(0), lambda s, n: s + n)


def _check_digit(digits: Column) -> Column:
    return F.pmod(F.lit(10) - F.pmod(_luhn_sum(digits), F.lit(10)), F.lit(10))


def _card(m: Column, key: str) -> Column:
    plain = F.regexp_replace(m, "[^0-9]", "")

    def other(d):
        body = F.substr(d, F.lit(1), F.length(d) - 1)
        left = F.floor((F.length(body) / 2)).cast("int")

        def write(p):
            new = F.concat(_digits(p["x"], left), _digits(p["y"], F.length(body) - left))
            new = F.concat(new, _check_digit(new))
            # The new digits take the places of the old ones; blanks and hyphens stay.
            places = F.split(m, "")
            number = F.transform(places, lambda c, k: F.length(F.regexp_replace(F.substr(m, F.lit(1), k + 1), "[^0-9]", "")))
            return F.array_join(F.transform(F.arrays_zip(places.alias("c"), number.alias("n")), lambda z: F.when(
                z["c"].rlike("[0-9]"), F.substr(new, z["n"], F.lit(1))).otherwise(z["c"])), "")

        ten = F.lit(10).cast("double")
        pair = feistel(F.substr(body, F.lit(1), left), F.substr(body, left + 1),
                       F.pow(ten, left).cast("long"), F.pow(ten, F.length(body) - left).cast("long"), "card", key)
        valid = F.substr(d, F.length(d)) == _check_digit(body).cast("string")
        return F.when(valid, _let(pair, write)).otherwise(m)

    return _let(plain, other)


def _phone(m: Column, key: str) -> Column:
    area, rest = F.substring(m, 5, 3).cast("long"), F.concat(F.substring(m, 10, 3), F.substring(m, 14, 4)).cast("long")

    def part(v, at, n):
        """Start and size of the part of 0 to n - 1, cut at ``at``, that v is in."""
        return F.when(v < at, 0).otherwise(at), F.when(v < at, at).otherwise(n - at)

    (x, a), (y, b) = part(area, 200, 1_000), part(rest, 2_000_000, 10_000_000)

    def write(p):
        r = _digits(p["y"] + y, 7)
        return F.concat(F.lit("+1 ("), _digits(p["x"] + x, 3), F.lit(") "), F.substring(r, 1, 3), F.lit("-"), F.substring(r, 4, 4))

    return _let(feistel(area - x, rest - y, a, b, "phone", key), write)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, at, n).cast("long") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area >= 1) & (area <= 899) & (area != 666) & (group >= 1) & (serial >= 1)
    place = F.when(area > 666, area - 2).otherwise(area - 1)

    def write(p):
        new = F.when(p["x"] >= 665, p["x"] + 2).otherwise(p["x"] + 1)
        return F.concat(_digits(new, 3), F.lit("-"), _digits(F.floor(p["y"] / 9999) + 1, 2), F.lit("-"), _digits(p["y"] % 9999 + 1, 4))

    return F.when(valid, _let(feistel(place, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "ssn", key), write)).otherwise(m)


def _ip(m: Column, key: str) -> Column:
    part = F.transform(F.split(m, r"\."), lambda s: s.cast("long"))
    at = [F.get(part, F.lit(k)) for k in range(4)]

    def write(p):
        return F.concat_ws(".", F.floor(p["x"] / 256), p["x"] % 256, F.floor(p["y"] / 256), p["y"] % 256)

    pair = feistel(at[0] * 256 + at[1], at[2] * 256 + at[3], 65_536, 65_536, "ip", key)
    return F.when(F.array_max(part) <= 255, _let(pair, write)).otherwise(m)


def _date(m: Column, key: str) -> Column:
    def in_format(form: str):
        def other(day):
            n = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
            pair = feistel(F.floor(n / DAYS[1]), n % DAYS[1], *DAYS, "date", key)
            return F.when(day.isNull(), m).otherwise(_let(pair, lambda p: F.date_format(
                F.date_add(F.lit(FIRST_DAY).cast("date"), (p["x"] * DAYS[1] + p["y"]).cast("int")), form)))
        return _let(F.to_date(F.try_to_timestamp(m, F.lit(form))), other)

    return F.when(m.rlike("^[0-9]{4}-"), in_format("yyyy-MM-dd")).when(m.contains("/"), in_format("dd/MM/yyyy")).otherwise(in_format("dd.MM.yyyy"))


def _email(m: Column, key: str) -> Column:
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws(":", F.lit(key), F.lit("email"), F.lower(m)), 256), 1, 16), F.lit("@pseudonym.invalid"))


MAKE = {"email": _email, "phone": _phone, "date": _date, "ssn": _ssn, "ip": _ip, "card": _card}


def pseudonym(m: Column, key: str = KEY) -> Column:
    """The pseudonym of one candidate; the candidate itself if it does not validate."""
    out = m
    for kind in reversed(KINDS):
        # Candidates are whole matches of one alternative; their shapes tell the kinds apart.
        out = F.when(m.rlike(SHAPES[kind]), MAKE[kind](m, key)).otherwise(out)
    return out


# The shape of a candidate of each kind, without what surrounds it.
SHAPES = {"email": "@", "phone": r"^\+1 ", "date": r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})$",
          "ssn": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$", "ip": r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$", "card": r"^(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[0-9 -]+)$"}


def pseudonymise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = KEY) -> DataFrame:
    """id, text with pseudonyms, and the number of replaced values of each kind, for every row."""
    text = F.col(text_col)
    some = text.rlike(NEEDS)
    found = F.when(some, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), found.alias("found"))
    rows = rows.withColumn("new", F.transform("found", lambda m: pseudonym(m, key)))
    pieces = F.split("text", ANY, -1)
    joined = F.array_join(F.transform(F.arrays_zip(pieces.alias("a"), F.col("new").alias("b")), lambda z: F.concat(
        z["a"], F.coalesce(z["b"], F.lit("")))), "")
    pairs = F.arrays_zip(F.col("found").alias("m"), F.col("new").alias("p"))

    def replaced(kind: str) -> Column:
        own = F.filter(pairs, lambda z: (z["m"] != z["p"]) & z["m"].rlike(SHAPES[kind]))
        return F.coalesce(F.size(own), F.lit(0)).cast("long").alias(f"n_{kind}")

    n = [replaced(k) for k in KINDS]
    return rows.select(F.col("id").alias(id_col), F.when(F.size("found") > 0, joined).otherwise(F.col("text")).alias(text_col), *n)


def op7_pii(spark, sf_dir: str) -> DataFrame:
    from ticklake.llm.common import table
    return pseudonymise(table(spark, sf_dir, "documents"))
