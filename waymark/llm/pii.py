"""Format-preserving Feistel pseudonyms for personal values in text.

Candidates are found with one regular expression and validated: card numbers
by their check digit (also beside other numbers, see ``run_replaced``), dates by
the calendar, addresses by octet range, social security numbers by their
reserved areas.  A valid value is replaced by the
image of its canonical form under a keyed Feistel permutation of the set of
values of the same format, so the result is again a valid value of that format,
equal values (also when they are punctuated differently) get equal pseudonyms
in every document, different values get different ones, and the holder of the
key can invert the map.  Candidates that fail validation stay.

========  ==================================  =====================================
kind      validated by                        permuted set
========  ==================================  =====================================
email     shape of address and domain         strings of the same character classes
                                              before the top-level domain
ipv4      four octets of 0-255                the 2^32 addresses
date      ISO or day/month/year, calendar     the 271^2 days from 1900-01-01
ssn       areas 000, 666, 9xx refused         nine digits
phone     area and line groups                the digits after the country code
card      13-19 digits, Luhn                  Luhn-valid numbers of that length
========  ==================================  =====================================

Only built-in functions: split and regexp_extract_all cut the text at the same
matches, a lambda maps each match and concat joins the pieces.  Rows are
independent, so there is no shuffle.

Null text stays null with zero replacements; empty text stays empty; other
columns pass through, repeated rows too; a column called ``n_pii`` in the input
is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import without

ROUNDS = 10
EPOCH = "1900-01-01"
DATE_HALF = 271
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()

EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-][A-Za-z0-9._%+-]{0,63}"
         r"@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])")
IPV4 = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
ISO_DATE = r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])"
DMY_DATE = r"(?<![\d/])\d{2}/\d{2}/\d{4}(?![\d/])"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = (r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)")
PHONE_PLAIN = r"(?<![\w+])\+\d{10,14}(?!\d)"
# A run of digit groups; it ends before a value that has other punctuation as well.
_DOTTED = r"\d{3}(?:\.\d{3}[ .-]|[ -]\d{3}\.)\d{4}(?!\d)"
RUN = rf"(?<![\d+])\d(?:(?:[ -](?!{EMAIL}|{IPV4}|{DMY_DATE}|{_DOTTED}))?\d){{12,}}+"
# The groupings cards are printed in, with one kind of separator.
CARD = (r"\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{3})?|\d{4}([ -])\d{6}\2\d{4,5}|\d{4}([ -])\d{5}\3\d{6}"
        r"|\d{4}([ -])\d{3}\4\d{3}\4\d{3}|\d{4}([ -])\d{4}\5\d{5}|\d{6}([ -])\d{13}")
CARD_GROUPS = 5
IN_RUN = "|".join([ISO_DATE, SSN, PHONE])
CANDIDATE = "|".join([EMAIL, IPV4, ISO_DATE, DMY_DATE, SSN, PHONE, PHONE_PLAIN, RUN])


def _hash(key: str, kind: str, rnd: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), rnd.cast("string"), half.cast("string")), 256)


def _shifted(text: Column, h: Column) -> Column:
    """Each digit or letter moved within its class by an amount from the hash."""
    def one(c: Column, i: Column) -> Column:
        by = F.conv(F.substr(h, (i * 3) % 61 + 1, F.lit(3)), 16, 10).cast("int")
        out = c
        for letters in (UPPER, LOWER, DIGITS):
            at = F.instr(F.lit(letters), c)
            out = F.when(at > 0, F.substr(F.lit(letters), (at - 1 + by) % len(letters) + 1, F.lit(1))).otherwise(out)
        return out
    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one), "")


def permuted_string(text: Column, key: str, kind: str) -> Column:
    """Feistel network on the two halves of a string; every character keeps its class."""
    mid = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substr(text, F.lit(1), mid).alias("a"),
                     F.substr(text, mid + 1, F.length(text)).alias("b"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start,
        lambda s, r: F.struct(s["b"].alias("a"), _shifted(s["a"], _hash(key, kind, r, s["b"])).alias("b")),
        lambda s: F.concat(s["a"], s["b"]))


def permuted_number(value: Column, half: int, key: str, kind: str) -> Column:
    """Feistel network on ``value`` in 0 .. half^2 - 1 as two digits of base ``half``."""
    start = F.struct(F.floor(value / half).cast("long").alias("a"), (value % half).cast("long").alias("b"))

    def step(s: Column, r: Column) -> Column:
        f = F.conv(F.substr(_hash(key, kind, r, s["b"]), F.lit(1), F.lit(12)), 16, 10).cast("long")
        return F.struct(s["b"].alias("a"), ((s["a"] + f) % half).alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: s["a"] * half + s["b"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _refilled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in order; punctuation stays."""
    start = F.struct(F.lit("").alias("o"), F.lit(1).alias("i"))
    return F.aggregate(
        F.split(shape, ""), start,
        lambda s, c: F.when(c.rlike(r"^\d$"), F.struct(F.concat(s["o"], F.substr(digits, s["i"], F.lit(1))).alias("o"),
                                                       (s["i"] + 1).alias("i")))
                      .otherwise(F.struct(F.concat(s["o"], c).alias("o"), s["i"].alias("i"))),
        lambda s: s["o"])


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum; ``doubled``: parity, counted from the right, of the doubled places."""
    def add(s: Column, x: Column) -> Column:
        return s + x

    def term(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == doubled, twice).otherwise(d)

    parts = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(F.transform(parts, term), F.lit(0), add)


def pseudonym(m: Column, key: str) -> Column:
    """The replacement of one candidate other than a run, or the candidate itself if it isn't valid."""
    tld = F.regexp_extract(m, r"(\.[A-Za-z]+)$", 1)
    head = F.substr(m, F.lit(1), F.length(m) - F.length(tld))
    email = F.concat(permuted_string(F.lower(head), key, "email"), tld)

    octet = F.transform(F.split(m, r"\."), lambda o: o.cast("long"))
    as_int = F.aggregate(octet, F.lit(0).cast("long"), lambda s, o: s * 256 + o)
    ip = permuted_number(as_int, 65536, key, "ipv4")
    dotted = F.concat_ws(".", *[(F.floor(ip / 256 ** k) % 256).cast("long").cast("string") for k in (3, 2, 1, 0)])
    ip_ok = F.forall(octet, lambda o: o <= 255)

    def dated(fmt: str) -> tuple[Column, Column]:
        day = F.try_to_timestamp(m, F.lit(fmt)).cast("date")
        n = F.datediff(day, F.lit(EPOCH).cast("date"))
        ok = day.isNotNull() & (n >= 0) & (n < DATE_HALF ** 2) & (F.date_format(day, fmt) == m)
        moved = F.date_add(F.lit(EPOCH).cast("date"), permuted_number(n, DATE_HALF, key, "date").cast("int"))
        return ok, F.date_format(moved, fmt)

    iso_ok, iso = dated("yyyy-MM-dd")
    dmy_ok, dmy = dated("dd/MM/yyyy")
    d = _digits(m)
    ssn = _refilled(m, permuted_string(d, key, "ssn"))
    ssn_ok = ~d.rlike(r"^(000|666|9)")
    cc = F.when(m.startswith("+"), F.greatest(F.length(d) - 10, F.lit(0))).otherwise(0)
    phone = _refilled(m, F.concat(F.substr(d, F.lit(1), cc),
                                  permuted_string(F.substr(d, cc + 1, F.length(d)), key, "phone")))

    def whole(p: str) -> Column:
        return m.rlike(f"^(?:{p})$")

    return (F.when(m.contains("@"), email)
             .when(whole(IPV4), F.when(ip_ok, dotted).otherwise(m))
             .when(whole(ISO_DATE), F.when(iso_ok, iso).otherwise(m))
             .when(whole(DMY_DATE), F.when(dmy_ok, dmy).otherwise(m))
             .when(whole(SSN), F.when(ssn_ok, ssn).otherwise(m))
             .when(whole(PHONE) | whole(PHONE_PLAIN), phone)
             .otherwise(m))


def _card_ok(m: Column) -> Column:
    d = _digits(m)
    return F.when(F.length(d).between(13, 19), _luhn_sum(d, 1) % 10 == 0).otherwise(False)


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    body = permuted_string(F.substr(d, F.lit(1), F.length(d) - 1), key, "card")
    check = ((10 - _luhn_sum(body, 0) % 10) % 10).cast("string")
    return _refilled(m, F.concat(body, check))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _counted(m: Column, new: Column) -> Column:
    """struct(t, n): a replacement and the number of values it replaces."""
    return _let(new, lambda x: F.struct(x.alias("t"), F.when(x == m, 0).otherwise(1).alias("n")))


def _joined(gaps: Column, values: Column) -> Column:
    """struct(t, n) of a text from the gaps between its candidates and their struct(t, n)."""
    t = F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(values, i)["t"], F.lit("")))), "")
    return F.struct(t.alias("t"), F.aggregate(values, F.lit(0), lambda s, v: s + v["n"]).alias("n"))


def _cut(groups: Column) -> Column:
    """Array of struct(t, card): a run's groups with the cards among them joined, from left to
    right, at each group the longest valid one in a card's grouping."""
    def piece(t: Column, card: bool) -> Column:
        return F.struct(t.alias("t"), F.lit(card).alias("card"))

    def window(i: Column, k: Column) -> Column:
        return F.regexp_replace(F.array_join(F.slice(groups, i, k), ""), "[ -]$", "")

    def longest(i: Column) -> Column:
        ks = F.sequence(F.lit(1), F.least(F.lit(CARD_GROUPS), F.size(groups) - i + 1))
        return F.array_max(F.filter(ks, lambda k: _let(window(i, k), lambda w: w.rlike(f"^(?:{CARD})$") & _card_ok(w))))

    # For each group a card could start at: how many groups the card has.
    cards = F.filter(F.transform(F.sequence(F.lit(1), F.size(groups)), lambda i: F.struct(i.alias("i"), longest(i).alias("k"))),
                     lambda c: c["k"].isNotNull())
    # Those that overlap one further left are left out.
    taken = F.aggregate(cards, F.array().cast("array<struct<i:int,k:int>>"),
                        lambda s, c: F.when(c["i"] >= F.coalesce(F.get(s, F.size(s) - 1)["i"] + F.get(s, F.size(s) - 1)["k"], F.lit(1)),
                                            F.concat(s, F.array(c))).otherwise(s))

    def pieces(cs: Column) -> Column:
        def before(c: Column, j: Column) -> Column:
            p = F.get(cs, j - 1)
            return F.when(j == 0, F.array_join(F.slice(groups, F.lit(1), c["i"] - 1), "")).otherwise(
                F.concat(F.regexp_extract(F.get(groups, p["i"] + p["k"] - 2), "[ -]?$", 0),
                         F.array_join(F.slice(groups, p["i"] + p["k"], c["i"] - p["i"] - p["k"]), "")))

        end = F.struct((F.size(groups) + 1).alias("i"), F.lit(0).alias("k"))
        two = F.transform(cs, lambda c, j: F.array(piece(before(c, j), False), piece(window(c["i"], c["k"]), True)))
        return F.concat(F.flatten(two), F.array(piece(before(end, F.size(cs)), False)))

    return _let(taken, pieces)


def run_replaced(m: Column, key: str) -> Column:
    """struct(t, n) of a run of digit groups: its cards, then the other kinds in what is
    between; a run without any is a card if all of its digits are one."""
    def between(t: Column) -> Column:
        values = F.transform(F.regexp_extract_all(t, F.lit(IN_RUN), F.lit(0)), lambda v: _counted(v, pseudonym(v, key)))
        return _let(values, lambda vs: _joined(F.split(t, IN_RUN, -1), vs))

    def whole(parts: Column) -> Column:
        return F.struct(F.array_join(F.transform(parts, lambda p: p["t"]), "").alias("t"),
                        F.aggregate(parts, F.lit(0), lambda s, p: s + p["n"]).alias("n"))

    parts = F.transform(_let(F.regexp_extract_all(m, F.lit(r"\d+[ -]?"), F.lit(0)), _cut),
                        lambda p: F.when(p["card"], _counted(p["t"], _card(p["t"], key))).otherwise(between(p["t"])))
    none = F.struct(m.alias("t"), F.lit(0).alias("n"))
    found = F.when(m.rlike("[ -]"), _let(parts, whole)).otherwise(none)
    return _let(found, lambda w: F.when((w["n"] == 0) & _card_ok(m), _counted(m, _card(m, key))).otherwise(w))


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with personal values in ``text`` replaced, plus ``n_pii`` (int),
    the number of values replaced.  ``key`` is the secret of the permutation."""
    docs = without(docs, {"n_pii"})
    t = F.col(f"`{text}`")
    # Texts without a digit or an @ hold no candidate; the search skips them.
    found = F.when(t.rlike("[0-9@]"), F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0)))
    values = F.transform("_wm_found", lambda m: F.when(m.rlike(r"^\d(?:[ -]?\d){12,}+$") & ~m.rlike(f"^(?:{IN_RUN})$"),
                                                       run_replaced(m, key)).otherwise(_counted(m, pseudonym(m, key))))
    done = docs.withColumn("_wm_found", found).withColumn("_wm_new", F.when(F.size("_wm_found") > 0, values))
    new = F.col("_wm_new").isNotNull()
    joined = _joined(F.split(t, CANDIDATE, -1), F.col("_wm_new"))
    return (done.withColumn("n_pii", F.when(new, joined["n"]).otherwise(0).cast("int"))
                .withColumn(text, F.when(new, joined["t"]).otherwise(t))
                .drop("_wm_found", "_wm_new"))
