"""PII: format-preserving Feistel pseudonyms (operator 8), DataFrame functions only.

Emails, IPv4 addresses, dates, phone numbers, social security numbers and card numbers
are found by one pattern and validated (octets, calendar, issuable social security numbers, Luhn). Each valid value is
permuted within its own format by a keyed alternating Feistel network, so equal values get
equal pseudonyms in every document and different values different ones; what does not
validate stays. The network adds keyed hashes of one half to the other, modulo the size of
that half, so it permutes any product of two ranges and needs no cycle walking.

A card is sought in the whole run of digit groups around it, since an expiry date, a check
number or a year may stand next to it: at any borders of groups, 13 to 19 digits that pass Luhn
are a card if the groups are laid out as on cards (or are one group), if they have the prefix and
length of a card network, or if they are the whole run. Where such cards overlap, those with
both layout and network come first, then those laid out as cards, then the whole run, then the
network's; then the first in the run, then the one of fewest groups.

Phone numbers are ten digits whose area code is in brackets or followed by ``.`` or ``-``, with
or without a country code; other formats stay.

Cards keep length and separators and stay Luhn-valid, phones keep country code and a valid
first digit of area and exchange, dates stay in 1900-2099, emails keep their domain and the
place of letters, digits and signs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

ROUNDS = 8
#: For the registered query; a production run passes its own secret.
DEMO_KEY = "roomrate-demo-key"
_EMAIL = r"(?<![\w.%+-])[\w.%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
_IP = r"(?<!\d)(?<!\d\.)\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"
_DATE = r"(?<!\d)(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?!\d)"
_PHONE = r"(?<!\d)(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[.-])\d{3}[ .-]\d{4}(?!\d)"
_SSN = r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)"
#: A run of 13 digits or more that ends where another kind begins. Possessive: long runs need no stack.
_CARD = rf"(?<!\d)\d(?:(?:[ -](?!{_EMAIL}|{_IP}|{_DATE}|{_PHONE}|{_SSN}))?\d){{12,}}+"
#: Digits of the groups of a card, besides those in one group.
_LAYOUTS = ["4-4-4-4", "4-6-5", "4-6-4", "4-4-4-1", "4-4-5", "4-4-4-4-1", "4-4-4-4-2", "4-4-4-4-3", "6-13", "8-8"]
#: Prefixes and lengths of the card networks.
_NETWORK = (
    r"^(?:4\d{12}(?:\d{3}){0,2}|(?:5[1-5]\d\d|222[1-9]|22[3-9]\d|2[3-6]\d\d|27[01]\d|2720|220[0-4])\d{12}|3[47]\d{13}"
    r"|3(?:0[0-59]|[689]\d)\d{11}(?:\d{2}){0,1}|35(?:2[89]|[3-8]\d)\d{12,15}|6(?:011|4[4-9]\d|5\d\d|2\d\d)\d{12,15}"
    r"|(?:5[0678]\d\d|6[037]\d\d)\d{9,15}|(?:508\d|8[12]\d\d|9792)\d{12})$"
)
#: In order of preference at the same place.
KINDS = {"email": _EMAIL, "ip": _IP, "date": _DATE, "phone": _PHONE, "ssn": _SSN, "card": _CARD}
PATTERN = "|".join(KINDS.values())
_FIRST_DAY, _DAYS_A, _DAYS_B = "1900-01-01", 319, 229  # 319 * 229 days are 1900-01-01 to 2099-12-31


def _prf(key: str, kind: str, i: Column, half: Column) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{key}|{kind}|"), i.cast("string"), F.lit("|"), half.cast("string")).cast("binary"), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _network(key: str, kind: str, a: Column, b: Column, size_a: Column, size_b: Column) -> Column:
    """Struct (a, b): the image of the pair within [0, size_a) x [0, size_b)."""

    def step(s: Column, i: Column) -> Column:
        left = i % 2 == 1
        return F.struct(
            F.when(left, (s["a"] + _prf(key, kind, i, s["b"])) % size_a).otherwise(s["a"]).alias("a"),
            F.when(left, s["b"]).otherwise((s["b"] + _prf(key, kind, i, s["a"])) % size_b).alias("b"),
        )

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(1, ROUNDS + 1)]), start, step)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def _pad(n: Column, width: Column | int) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def _refill(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced, in order, by ``digits``."""
    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("k"))

    def step(acc: Column, c: Column) -> Column:
        is_digit = c.rlike("[0-9]")
        return F.struct(
            F.concat(acc["s"], F.when(is_digit, F.substr(digits, acc["k"], F.lit(1))).otherwise(c)).alias("s"),
            (acc["k"] + F.when(is_digit, 1).otherwise(0)).alias("k"),
        )

    return F.aggregate(F.split(m, ""), start, step, lambda acc: acc["s"])


def luhn_sum(digits: Column) -> Column:
    n = F.length(digits)

    def step(acc: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int") * (1 + (n - i) % 2)
        return acc + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step)


def _number(key: str, kind: str, digits: Column) -> Column:
    """Image of a digit string among those of its length."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    size = lambda w: F.rpad(F.lit("1"), w + 1, "0").cast("long")
    a, b = F.substr(digits, F.lit(1), u).cast("long"), F.substr(digits, u + 1, n).cast("long")
    return _let(_network(key, kind, a, b, size(u), size(n - u)), lambda s: F.concat(_pad(s["a"], u), _pad(s["b"], n - u)))


def _card(key: str, m: Column) -> Column:
    """Image of the Luhn-valid digits in ``m``, with its separators."""

    def image(d: Column) -> Column:
        payload = F.substr(d, F.lit(1), F.length(d) - 1)
        return _let(
            _number(key, "card", payload),
            lambda p: _refill(m, F.concat(p, ((10 - luhn_sum(F.concat(p, F.lit("0"))) % 10) % 10).cast("string"))),
        )

    return _let(_digits(m), image)


def _windows(groups: Column) -> Column:
    """(at, n, digits, layout) of every 13 to 19 digits between borders of the ``groups`` of a run,
    a lambda variable: an expression would be evaluated anew for each of them."""

    def window(i: Column, n: Column) -> Column:
        return _let(
            F.slice(groups, i, n),
            lambda g: F.struct(
                i.alias("at"), n.alias("n"), F.array_join(g, "").alias("digits"),
                F.array_join(F.transform(g, lambda x: F.length(x).cast("string")), "-").alias("layout"),
            ),
        )

    def fitting(sizes: Column, i: Column) -> Column:
        """How many of the next 19 borders come before the 13th digit (few), and by the 19th (most)."""
        start = F.struct(F.lit(0).cast("long").alias("digits"), F.lit(0).alias("few"), F.lit(0).alias("most"))

        def step(acc: Column, size: Column) -> Column:
            total = acc["digits"] + size
            return F.struct(
                total.alias("digits"), (acc["few"] + F.when(total < 13, 1).otherwise(0)).alias("few"),
                (acc["most"] + F.when(total <= 19, 1).otherwise(0)).alias("most"),
            )

        return F.aggregate(F.slice(sizes, i, 19), start, step)

    def at(sizes: Column, i: Column) -> Column:
        none = F.array().cast("array<struct<at:int,n:int,digits:string,layout:string>>")
        return _let(
            fitting(sizes, i),
            lambda s: F.when(s["most"] > s["few"], F.transform(F.sequence(s["few"] + 1, s["most"]), lambda n: window(i, n))).otherwise(none),
        )

    starts = F.sequence(F.lit(1), F.size(groups))
    return _let(F.transform(groups, F.length), lambda sizes: F.flatten(F.transform(starts, lambda i: at(sizes, i))))


def _cards(windows: Column, n_groups: Column) -> Column:
    """(at, n) of the cards among the ``windows``, none overlapping, in order."""

    def rank(w: Column) -> Column:
        laid_out = (w["n"] == 1) | w["layout"].isin(_LAYOUTS)
        network = w["digits"].rlike(_NETWORK)
        return F.when(laid_out & network, 1).when(laid_out, 2).when(w["n"] == n_groups, 3).when(network, 4)

    valid = F.filter(windows, lambda w: luhn_sum(w["digits"]) % 10 == 0)
    ranked = F.transform(valid, lambda w: F.struct(rank(w).alias("rank"), w["at"].alias("at"), w["n"].alias("n")))
    ranked = F.array_sort(F.filter(ranked, lambda w: w["rank"].isNotNull()))
    spans = "array<struct<at:int,n:int>>"

    def first_come(ws: Column) -> Column:
        """Of windows in order, each that starts after the last one taken ends."""
        start = F.struct(F.lit(1).alias("free"), F.array().cast(spans).alias("taken"))

        def step(acc: Column, w: Column) -> Column:
            span = F.array(F.struct(w["at"].alias("at"), w["n"].alias("n")))
            more = F.struct((w["at"] + w["n"]).alias("free"), F.concat(acc["taken"], span).alias("taken"))
            return F.when(w["at"] >= acc["free"], more).otherwise(acc)

        return F.aggregate(ws, start, step, lambda acc: acc["taken"])

    def used(taken: Column) -> Column:
        """For each group of the run, whether one of the ``taken`` windows, in order, holds it."""
        end = lambda t: F.coalesce(t["at"] + t["n"], F.lit(1))
        upto = F.transform(
            taken, lambda t, i: F.concat(F.array_repeat(F.lit(False), t["at"] - end(F.get(taken, i - 1))), F.array_repeat(F.lit(True), t["n"])))
        rest = F.array_repeat(F.lit(False), n_groups + 1 - end(F.get(taken, F.size(taken) - 1)))
        return F.concat(F.flatten(upto), rest)

    def take(of: Column, taken: Column, rank: int) -> Column:
        """The windows taken so far and those of this rank beside them, in order."""
        same = F.filter(of, lambda w: w["rank"] == rank)
        beside = lambda u: F.filter(same, lambda w: ~F.exists(F.slice(u, w["at"], w["n"]), lambda x: x))
        more = _let(used(taken), lambda u: first_come(beside(u)))
        both = F.when(F.exists(of, lambda w: w["rank"] == rank), F.array_sort(F.concat(taken, more))).otherwise(taken)
        return both if rank == 4 else _let(both, lambda t: take(of, t, rank + 1))

    return _let(ranked, lambda of: _let(F.array().cast(spans), lambda t: take(of, t, 1)))


def _run(key: str, m: Column) -> Column:
    """Struct (value, found) of a run of digit groups: its text with the cards replaced, and the
    cards; the run itself is found, unchanged, if it could hold a card but none is valid."""
    groups = F.split(m, "[ -]")
    ends = F.concat(F.regexp_extract_all(m, F.lit("[ -]"), F.lit(0)), F.array(F.lit("")))
    pieces = F.zip_with(groups, ends, lambda g, e: F.concat(g, e))
    text = lambda p, at, n: F.array_join(F.slice(p, at, n), "")
    entry = lambda v: F.struct(F.lit("card").alias("kind"), v.alias("value"))

    def replaced(p: Column, cards: Column) -> Column:
        start = F.struct(F.lit("").alias("s"), F.lit(1).alias("k"))

        def step(acc: Column, c: Column) -> Column:
            return F.struct(F.concat(acc["s"], text(p, acc["k"], c["at"] - acc["k"]), c["value"]).alias("s"), (c["at"] + c["n"]).alias("k"))

        return F.aggregate(cards, start, step, lambda acc: F.concat(acc["s"], text(p, acc["k"], F.size(p))))

    def made(p: Column, windows: Column) -> Column:
        images = F.transform(
            _cards(windows, F.size(p)),
            lambda c: F.struct(c["at"].alias("at"), c["n"].alias("n"), _card(key, text(p, c["at"], c["n"])).alias("value")),
        )
        none = F.when(F.size(windows) > 0, F.array(entry(m))).otherwise(F.array().cast("array<struct<kind:string,value:string>>"))
        return _let(
            images,
            lambda cards: F.struct(
                replaced(p, cards).alias("value"),
                F.when(F.size(cards) > 0, F.transform(cards, lambda c: entry(F.rtrim(F.regexp_replace(c["value"], "-$", ""))))).otherwise(none).alias("found"),
            ),
        )

    return _let(pieces, lambda p: _let(F.transform(p, _digits), lambda g: _let(_windows(g), lambda w: made(p, w))))


def _ssn(key: str, m: Column) -> Column:
    """Image among the numbers that can be issued: area 001 to 899 but 666, no part of zeros only."""

    def image(d: Column) -> Column:
        area, group, serial = (F.substr(d, F.lit(i), F.lit(n)).cast("int") for i, n in ((1, 3), (4, 2), (6, 4)))
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        at = area - F.when(area > 666, 2).otherwise(1)
        pair = _network(key, "ssn", at * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999))
        area_of = lambda s: F.floor(s["a"] / 99) + F.when(F.floor(s["a"] / 99) >= 665, 2).otherwise(1)
        digits = lambda s: F.concat(_pad(area_of(s), 3), _pad(s["a"] % 99 + 1, 2), _pad(s["b"] + 1, 4))
        return F.when(valid, _let(pair, lambda s: _refill(m, digits(s)))).otherwise(m)

    return _let(_digits(m), image)


def _phone(key: str, m: Column) -> Column:
    def image(d: Column) -> Column:
        n = F.length(d)
        code = F.substr(d, F.lit(1), n - 10)
        area, exchange, line = (F.substr(d, n - k, F.lit(w)).cast("int") for k, w in ((9, 3), (6, 3), (3, 4)))
        low = lambda x: F.when(x >= 200, 200).otherwise(0)
        span = lambda x: F.when(x >= 200, 800).otherwise(200).cast("long")
        pair = _network(key, "phone", area - low(area), (exchange - low(exchange)) * 10000 + line, span(area), span(exchange) * 10000)
        return _let(
            pair,
            lambda s: _refill(
                m,
                F.concat(
                    code, _pad(s["a"] + low(area), 3),
                    _pad(F.floor(s["b"] / 10000) + low(exchange), 3), _pad(s["b"] % 10000, 4),
                ),
            ),
        )

    return _let(_digits(m), image)


def _ip(key: str, m: Column) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))

    def image(o: Column) -> Column:
        pair = _network(key, "ip", o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536))
        parts = lambda s: F.concat_ws(".", F.floor(s["a"] / 256), s["a"] % 256, F.floor(s["b"] / 256), s["b"] % 256)
        return _let(pair, lambda s: F.when(F.array_max(o) <= 255, parts(s)).otherwise(m))

    return _let(octets, image)


def _date(key: str, m: Column) -> Column:
    def under(form: str, otherwise: Column) -> Column:
        def image(day: Column) -> Column:
            n = F.datediff(day, F.lit(_FIRST_DAY).cast("date"))
            pair = _network(key, "date", n % _DAYS_A, F.floor(n / _DAYS_A), F.lit(_DAYS_A), F.lit(_DAYS_B))
            moved = lambda s: F.date_add(F.lit(_FIRST_DAY).cast("date"), (s["b"] * _DAYS_A + s["a"]).cast("int"))
            inside = F.coalesce(n.between(0, _DAYS_A * _DAYS_B - 1), F.lit(False))
            return F.when(inside, _let(pair, lambda s: F.date_format(moved(s), form))).otherwise(otherwise)

        return _let(F.try_to_timestamp(m, F.lit(form)).cast("date"), image)

    slashes = under("dd/MM/yyyy", under("MM/dd/yyyy", m))
    dots = under("dd.MM.yyyy", m)
    return F.when(m.contains("-"), under("yyyy-MM-dd", m)).when(m.contains("/"), slashes).otherwise(dots)


def _email(key: str, m: Column) -> Column:
    """Letters and digits before the @ are shifted by keyed hashes of the other half."""

    def shifted(half: Column, other: Column, i: Column) -> Column:
        digest = F.sha2(F.concat(F.lit(f"{key}|email|"), i.cast("string"), F.lit("|"), other).cast("binary"), 512)

        def move(c: Column, p: Column) -> Column:
            by = F.conv(F.substr(digest, p * 2 + 1, F.lit(2)), 16, 10).cast("int")
            at = F.ascii(c)
            turn = lambda base, n: F.char((at - base + by) % n + base)
            return (
                F.when(at.between(97, 122), turn(97, 26)).when(at.between(65, 90), turn(65, 26))
                .when(at.between(48, 57), turn(48, 10)).otherwise(c)
            )

        return F.array_join(F.transform(F.split(half, ""), move), "")

    def step(s: Column, i: Column) -> Column:
        left = i % 2 == 1
        return F.struct(
            F.when(left, shifted(s["a"], s["b"], i)).otherwise(s["a"]).alias("a"),
            F.when(left, s["b"]).otherwise(shifted(s["b"], s["a"], i)).alias("b"),
        )

    cut = F.instr(m, "@") - 1
    half = F.floor((cut + 1) / 2).cast("int")
    start = F.struct(F.substr(m, F.lit(1), half).alias("a"), F.substr(m, half + 1, cut - half).alias("b"))
    rounds = F.array(*[F.lit(i) for i in range(1, ROUNDS + 1)])
    local = F.aggregate(rounds, start, step, lambda s: F.concat(s["a"], s["b"]))
    return F.concat(local, F.substr(m, cut + 1, F.length(m)))


def _kind(m: Column) -> Column:
    out = F.lit("card")
    for k in reversed(list(KINDS)[:-1]):
        out = F.when(m.rlike(f"^(?:{KINDS[k]})$"), k).otherwise(out)
    return out


def pseudonym(m: Column, key: str) -> Column:
    """Struct (kind, value, found) of one match: its text with pseudonyms, and an array of what it holds."""
    makers = {"email": _email, "ip": _ip, "date": _date, "phone": _phone, "ssn": _ssn}

    def made(k: Column) -> Column:
        value = m
        for name, make in makers.items():
            value = F.when(k == name, make(key, m)).otherwise(value)
        one = _let(value, lambda v: F.struct(v.alias("value"), F.array(F.struct(k.alias("kind"), v.alias("value"))).alias("found")))
        either = F.when(k == "card", _run(key, m)).otherwise(one)
        return _let(either, lambda x: F.struct(k.alias("kind"), x["value"].alias("value"), x["found"].alias("found")))

    return _let(_kind(m), made)


def masked(docs: DataFrame, text_col: str = "text", key: str = DEMO_KEY, name: str = "__pii") -> DataFrame:
    """Every row of ``docs`` plus struct ``name``: text with pseudonyms, and found (array of kind
    and pseudonym, valid or not, in order).

    Null text stays null; empty text stays empty; a text without a match is unchanged. Rows
    are handled one by one; other columns pass unchanged.
    """
    text = F.col(f"`{text_col}`")
    some = text.rlike("[0-9@]")
    found = F.when(some, F.transform(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), lambda m: pseudonym(m, key)))
    parts = F.when(some, F.split(text, PATTERN, -1))
    held, cut = fresh(docs, "__found"), fresh(docs, "__parts")
    none = F.array().cast("array<struct<kind:string,value:string,found:array<struct<kind:string,value:string>>>>")
    out = docs.withColumns({held: F.coalesce(found, none), cut: parts})
    values = F.concat(F.transform(held, lambda s: s["value"]), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(cut, values, lambda p, v: F.concat(p, v)), "")
    body = F.when(F.size(held) > 0, joined).otherwise(text)
    every = F.flatten(F.transform(held, lambda s: s["found"]))
    return out.withColumn(name, F.struct(body.alias("text"), every.alias("found"))).drop(held, cut)


def pseudonymised(docs: DataFrame, key: str = DEMO_KEY) -> DataFrame:
    """One row per document: doc_id, text, and how many values of each kind were found."""
    out = masked(docs.select("doc_id", "text"), key=key)
    of = F.transform("__pii.found", lambda s: s["kind"])
    counts = [(F.size(of) - F.size(F.array_remove(of, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", "__pii.text", *counts)
