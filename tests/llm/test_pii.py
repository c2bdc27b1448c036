import datetime as dt
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from ticklake.llm import pii

CARDS = ["4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005", "6011000990139424"]


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(d)) % 10 == 0


def run(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "x", 4) for i, t in enumerate(texts)], "doc_id long, text string, found string, new int")
    return [r for r in sorted(pii.pseudonymise(df, **kw).collect(), key=lambda r: r.doc_id)]


def test_formats_are_kept(spark):
    for c, r in zip(CARDS, run(spark, [f"x {c}, y" for c in CARDS])):
        new = r.text[2:-3]
        assert new != c and luhn(new) and re.sub("[0-9]", "0", new) == re.sub("[0-9]", "0", c) and r.n_card == 1
    r = run(spark, ["call +1 (457) 555-4685.", "ip 41.15.186.233 end", "ssn 123-45-6789", "on 2001-02-28, 28.02.2001 or 28/02/2001",
                    "mail Abc.Def+1@mail5.example.com!"])
    assert re.fullmatch(r"call \+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}\.", r[0].text) and "4685" not in r[0].text and r[0].n_phone == 1
    ip = re.fullmatch(r"ip (\d+)\.(\d+)\.(\d+)\.(\d+) end", r[1].text)
    assert ip and all(int(x) < 256 for x in ip.groups()) and r[1].n_ip == 1
    assert re.fullmatch(r"ssn \d{3}-\d{2}-\d{4}", r[2].text) and r[2].text != "ssn 123-45-6789"
    a, b, c = re.fullmatch(r"on (\S+), (\S+) or (\S+)", r[3].text).groups()
    day = dt.datetime.strptime(a, "%Y-%m-%d")
    assert day == dt.datetime.strptime(b, "%d.%m.%Y") == dt.datetime.strptime(c, "%d/%m/%Y") and r[3].n_date == 3
    assert re.fullmatch(r"mail u[0-9a-f]{16}@pseudonym\.invalid!", r[4].text) and r[4].n_email == 1


def test_equal_values_stay_linked(spark):
    a, b, c = run(spark, ["4111111111111111 and 4111111111111111", "é 4111111111111111", "4111111111111111"])
    x, y = a.text.split(" and ")
    assert x == y == b.text[2:] == c.text
    assert run(spark, ["4111111111111111"], key="other")[0].text != c.text


def test_what_does_not_validate_stays(spark):
    texts = ["4111111111111112", "2001-02-30", "256.1.1.1", "000-12-3456", "666-12-3456", "123-00-4567", "1.2.3.4.5",
             "12345678901234567890123", "2001-02-28-1", "a@b", "plain text", "", None, "99.99.2001", "1 2 3"]
    assert [r.text for r in run(spark, texts)] == texts


def test_long_repeated_and_empty(spark):
    long = "wörter 12 " * 20_000 + "4111111111111111"
    r = run(spark, [long, long])
    assert r[0].text == r[1].text and r[0].text.startswith(long[:-16]) and not r[0].text.endswith("1111111111")
    assert pii.pseudonymise(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("a, b", [(7, 13), (1, 5), (17, 4297)])
def test_feistel_is_a_permutation(spark, a, b):
    df = spark.range(a * b).select((F.col("id") % a).alias("x"), F.floor(F.col("id") / a).alias("y"))
    got = df.select(pii.feistel(F.col("x"), F.col("y"), a, b, "t", "k").alias("p"))
    assert got.distinct().count() == a * b and got.filter(f"p.x >= {a} or p.y >= {b} or p.x < 0 or p.y < 0").isEmpty()


def test_phone_of_a_low_area_is_replaced(spark):
    r = run(spark, ["+1 (157) 555-4685"])[0]
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", r.text) and r.text != "+1 (157) 555-4685" and r.n_phone == 1


def test_phones_of_any_area_and_exchange(spark):
    phones = [f"+1 ({a}) {e}-{n}" for a in ("000", "013", "157", "199", "200", "999") for e in ("000", "199", "200", "555") for n in ("0000", "9871")]
    got = run(spark, [f"call {p}, or {p}" for p in phones])
    new = [re.fullmatch(r"call (\+1 \(\d{3}\) \d{3}-\d{4}), or (.*)", r.text).groups() for r in got]
    assert all(a == b != p and r.n_phone == 2 for (a, b), p, r in zip(new, phones, got))
    assert len({a for a, _ in new}) == len(phones)
    # Numbers under 200 and the others stay among themselves, so the permutation is whole.
    assert all((a[4:7] < "200") == (p[4:7] < "200") and (a[9:12] < "200") == (p[9:12] < "200") for (a, _), p in zip(new, phones))


class Plain:
    """Pseudonyms by plain Python, from the statement of the method."""

    def __init__(self, key=pii.KEY):
        self.key = key

    def permuted(self, kind, x, y, a, b):
        def half(r, v):
            return int(hashlib.sha256(f"{self.key}:{kind}:{r}:{a}:{b}:{v}".encode()).hexdigest()[:14], 16) % (1 << 52)
        for r in range(1, pii.ROUNDS // 2 + 1):
            x = (x + half(2 * r, y)) % a
            y = (y + half(2 * r + 1, x)) % b
        return x, y

    def card(self, m):
        digits = [c for c in m if c.isdigit()]
        if not luhn(m):
            return m
        body = "".join(digits[:-1])
        h = len(body) // 2
        x, y = self.permuted("card", int(body[:h]), int(body[h:]), 10 ** h, 10 ** (len(body) - h))
        new = f"{x:0{h}d}{y:0{len(body) - h}d}"
        new += next(c for c in "0123456789" if luhn(new + c))
        left = iter(new)
        return "".join(next(left) if c.isdigit() else c for c in m)

    def phone(self, m):
        d = re.sub("[^0-9]", "", m)[1:]
        area, rest = int(d[:3]), int(d[3:])
        x0, a = (0, 200) if area < 200 else (200, 800)
        y0, b = (0, 2_000_000) if rest < 2_000_000 else (2_000_000, 8_000_000)
        x, y = self.permuted("phone", area - x0, rest - y0, a, b)
        r = f"{y + y0:07d}"
        return f"+1 ({x + x0:03d}) {r[:3]}-{r[3:]}"

    def ssn(self, m):
        area, group, serial = map(int, m.split("-"))
        areas = [n for n in range(1, 900) if n != 666]
        if area not in areas or not group or not serial:
            return m
        x, y = self.permuted("ssn", areas.index(area), (group - 1) * 9999 + serial - 1, len(areas), 99 * 9999)
        return f"{areas[x]:03d}-{y // 9999 + 1:02d}-{y % 9999 + 1:04d}"

    def ip(self, m):
        p = [int(x) for x in m.split(".")]
        if max(p) > 255:
            return m
        x, y = self.permuted("ip", p[0] * 256 + p[1], p[2] * 256 + p[3], 1 << 16, 1 << 16)
        return f"{x // 256}.{x % 256}.{y // 256}.{y % 256}"

    def date(self, m):
        form = "%Y-%m-%d" if "-" in m else "%d/%m/%Y" if "/" in m else "%d.%m.%Y"
        try:
            n = (dt.datetime.strptime(m, form).date() - dt.date(1900, 1, 1)).days
        except ValueError:
            return m
        x, y = self.permuted("date", n // 4297, n % 4297, 17, 4297)
        return (dt.date(1900, 1, 1) + dt.timedelta(x * 4297 + y)).strftime(form)

    def email(self, m):
        return "u" + hashlib.sha256(f"{self.key}:email:{m.lower()}".encode()).hexdigest()[:16] + "@pseudonym.invalid"

    def document(self, text):
        """(text, counts by kind): the kind of a candidate is that of the alternative that found it."""
        counts = dict.fromkeys(pii.KINDS, 0)

        def other(m):
            kind = m.lastgroup
            new = getattr(self, kind)(m[0])
            counts[kind] += new != m[0]
            return new
        found = re.compile("|".join(f"(?P<{k}>{p})" for k, p in pii.PATTERNS.items()))
        return (None if text is None else found.sub(other, text)), tuple(counts.values())


def test_query_against_plain_python(spark):
    sf = "/root/testdata/sf0.01"
    plain = Plain()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = pii.op7_pii(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.text, tuple(r[f"n_{k}"] for k in pii.KINDS)) == plain.document(docs[r.doc_id]), r.doc_id
    assert sum(sum(plain.document(t)[1]) for t in docs.values()) > 50


def test_awkward_values_against_plain_python(spark):
    texts = [*CARDS, *(f"a {c} b {c}." for c in CARDS), "899-99-9999 900-01-0001 665-01-0001 667-01-0001 001-01-0001", "0.0.0.0 255.255.255.255 256.1.1.1",
             "1900-01-01 2099-12-31 2000-02-29 1900-02-29 31/12/2099 30.02.2000", "+1 (199) 199-9999 +1 (200) 200-0000", "A@B.co a.b+c@d-e.f.org x@y"]
    for t, r in zip(texts, run(spark, texts)):
        assert (r.text, tuple(r[f"n_{k}"] for k in pii.KINDS)) == Plain().document(t), t
