"""Format-preserving pseudonyms with DataFrame functions only.

Numbers and dates that pass their validation are permuted by a keyed Feistel
network within their own format: equal values get equal pseudonyms in every
document and in every spelling, different values get different ones, and a
pseudonym passes the same validation. Mail addresses have no fixed format; they
get a keyed digest in the form of an address.

Cards in their usual groups are looked for first and by themselves, so a number
beside one (an expiry date, a check number, another card) does not hide it.
All other patterns work on the texts between them.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name

KEY = "tidemark"
ROUNDS = 10
FOUND = "array<struct<value:string,kind:string,pseudonym:string>>"

# An address starts where a run of its characters does, so a long run is tried once.
MAIL = r"(?<![A-Za-z0-9_.+-])[A-Za-z0-9_.+-]*[A-Za-z0-9_+-]@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
PATTERNS = {
    "mail": MAIL,
    "ip": rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])|(?<![0-9+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])|(?<![0-9.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?!-?[0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])",
}
# One run of digits or 4-4-4-4, 4-6-5 and 4-6-4, the groups beginning as card networks number them; not within a mail address.
CARD = r"(?<![A-Za-z0-9_.+@-])(?:[0-9]{13,19}|(?:[3-6][0-9]{3}|2[2-7][0-9]{2})(?:(?:[ -][0-9]{4}){3}|[ -][0-9]{6}[ -][0-9]{4,5}))(?![0-9]|[A-Za-z0-9_.+-]{0,64}@)"
# Country codes of one and two digits; all others have three.
COUNTRY_CODE = r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
KINDS = list(PATTERNS)
ANY = "|".join(PATTERNS.values())

# Days of a century that ends in a leap year or not, each as a product of two sides.
LEAP_CENTURY, COMMON_CENTURY = (75, 487), (92, 397)


def _number(*parts: Column | str) -> Column:
    """60 keyed bits."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 15), 16, 10).cast("bigint")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once; inside a lambda nothing else is shared."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("bigint")


def permute_digits(digits: Column, key: str, kind: str) -> Column:
    """A keyed permutation of the digit strings of each length from 2 to 36; other strings come back as they are."""

    def turned(d: Column, n: Column, u: Column, v: Column) -> Column:
        begin = F.struct(F.substring(d, F.lit(1), u).cast("bigint").alias("a"), F.substring(d, u + 1, v).cast("bigint").alias("b"))

        def turn(acc: Column, i: Column) -> Column:
            room = _power(F.when(i % 2 == 0, u).otherwise(v))
            return _let(room, lambda r: F.struct(acc["b"].alias("a"), ((acc["a"] + _number(F.lit(key), F.lit(kind), n.cast("string"), i.cast("string"), acc["b"].cast("string")) % r) % r).alias("b")))

        end = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), begin, turn)
        return _let(end, lambda e: F.concat(F.lpad(e["a"].cast("string"), u, "0"), F.lpad(e["b"].cast("string"), v, "0")))

    sized = lambda d: F.struct(d.alias("d"), F.length(d).alias("n"), F.shiftright(F.length(d), 1).alias("u"), (F.length(d) - F.shiftright(F.length(d), 1)).alias("v"))
    return _let(_let(digits, sized), lambda x: F.when(x["n"].between(2, 36), turned(x["d"], x["n"], x["u"], x["v"])).otherwise(x["d"]))


def _mixed(index: Column, left: Column, right: Column, key: Column) -> Column:
    """A keyed permutation of 0 .. left * right - 1: the two sides are shifted in turn by a digest of the other."""

    def turn(acc: Column, i: Column) -> Column:
        a = F.when(i % 2 == 0, (acc["a"] + _number(key, i.cast("string"), acc["b"].cast("string")) % left) % left).otherwise(acc["a"])
        b = F.when(i % 2 == 1, (acc["b"] + _number(key, i.cast("string"), acc["a"].cast("string")) % right) % right).otherwise(acc["b"])
        return F.struct(a.alias("a"), b.alias("b"))

    end = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), _let(index, lambda x: F.struct(F.floor(x / right).alias("a"), (x % right).alias("b"))), turn)
    return _let(end, lambda e: e["a"] * right + e["b"])


def permute_days(day: Column, key: str) -> Column:
    """A keyed permutation of the dates within each century."""
    century = F.floor(F.year(day) / 100) * 100
    first = F.make_date(century.cast("int"), F.lit(1), F.lit(1))
    leap = century % 400 == 0
    left = F.when(leap, LEAP_CENTURY[0]).otherwise(COMMON_CENTURY[0]).cast("bigint")
    right = F.when(leap, LEAP_CENTURY[1]).otherwise(COMMON_CENTURY[1]).cast("bigint")
    return F.date_add(first, _mixed(F.datediff(day, first).cast("bigint"), left, right, F.concat(F.lit(f"{key}|date|"), century.cast("string"))).cast("int"))


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string, the last digit counted once."""

    def worth(d: Column, k: Column) -> Column:
        twice = d * 2
        return F.when(k % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), lambda d, k: worth(d.cast("int"), k)), F.lit(0), lambda a, x: a + x)


def _fill(shape: Column, digits: Column) -> Column:
    """The digits put in the places of the digits of ``shape``."""
    return F.array_join(F.zip_with(F.split(shape, "[0-9]", -1), F.split(digits, ""), lambda gap, d: F.concat(gap, F.coalesce(d, F.lit("")))), "")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _date_of(value: Column) -> Column:
    """Date (null if there is none such), the text's separator, and whether its month comes first and its parts are padded."""
    split = F.struct(F.split(value, "[./-]").alias("p"), F.regexp_extract(value, "[./-]", 0).alias("mark"))

    def parts(x: Column) -> Column:
        one, two, three = (F.get(x["p"], k) for k in range(3))
        iso, american = x["mark"] == "-", (x["mark"] == "/") & (two.cast("int") > 12)
        return F.struct(
            F.when(iso, one).otherwise(three).alias("year"), F.when(american, one).otherwise(two).alias("month"),
            F.when(iso, three).when(american, two).otherwise(one).alias("day"), x["mark"].alias("mark"), american.alias("american"),
        )

    def dated(x: Column) -> Column:
        text = F.concat_ws("-", x["year"], F.lpad(x["month"], 2, "0"), F.lpad(x["day"], 2, "0"))
        padded = (F.length(x["day"]) == 2) & (F.length(x["month"]) == 2)
        return F.struct(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date").alias("date"), x["mark"].alias("mark"), x["american"].alias("american"), padded.alias("padded"))

    return _let(_let(split, parts), dated)


def _new_date(value: Column, key: str) -> Column:
    def written(x: Column) -> Column:
        american = (x["mark"] == "/") & x["american"]
        pattern = F.when(x["mark"] == "-", "yyyy-MM-dd").when(x["mark"] == ".", "dd.MM.yyyy").when(american, "MM/dd/yyyy").otherwise("dd/MM/yyyy")
        loose = F.replace(F.replace(pattern, F.lit("MM"), F.lit("M")), F.lit("dd"), F.lit("d"))
        return F.call_function("date_format", x["made"], F.when(x["padded"], pattern).otherwise(loose))

    made = lambda x: F.struct(permute_days(x["date"], key).alias("made"), x["mark"].alias("mark"), x["american"].alias("american"), x["padded"].alias("padded"))
    return _let(_let(_date_of(value), made), written)


def _new_ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda o: o.cast("bigint"))
    index = F.aggregate(octets, F.lit(0).cast("bigint"), lambda a, o: a * 256 + o)
    made = _mixed(index, F.lit(1 << 16).cast("bigint"), F.lit(1 << 16).cast("bigint"), F.lit(f"{key}|ip"))
    return _let(made, lambda m: F.concat_ws(".", *[F.shiftright(m, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]))


def _new_mail(value: Column, key: str) -> Column:
    low = F.lower(value)
    name, host = F.substring_index(low, "@", 1), F.substring_index(low, "@", -1)
    part = lambda x, n, kind: F.substring(F.sha2(F.concat_ws("|", F.lit(f"{key}|{kind}"), x), 256), 1, n)
    return F.concat(part(F.concat_ws("@", name, host), 16, "mail"), F.lit("@"), part(host, 8, "host"), F.lit(".example"))


def _new_phone(value: Column, key: str) -> Column:
    """The country code stays, with or without a separator after it."""
    code = F.regexp_extract(value, COUNTRY_CODE, 0)
    split = lambda c: F.struct(c.alias("code"), F.substring(value, F.length(c) + 1, F.length(value)).alias("rest"))
    return _let(_let(code, split), lambda x: F.concat(x["code"], _fill(x["rest"], permute_digits(_digits(x["rest"]), key, "phone"))))


def _new_card(value: Column, key: str) -> Column:
    body = _let(_digits(value), lambda d: permute_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, "card"))
    check = lambda b: (10 - _luhn(F.concat(b, F.lit("0"))) % 10) % 10
    return _let(body, lambda b: _fill(value, F.concat(b, check(b).cast("string"))))


def _kind(value: Column) -> Column:
    """The kind of a match, null if its validation fails."""
    is_kind = lambda k: value.rlike(f"^(?:{PATTERNS[k]})$")
    return (
        F.when(value.contains("@"), "mail")
        .when(is_kind("ip"), "ip")
        .when(is_kind("date"), F.when(F.year(_date_of(value)["date"]).between(1000, 9999), "date"))
        # Areas and groups that are never issued.
        .when(is_kind("ssn"), F.when(~value.rlike("^(?:000|666|9)|-00-|-0000$"), "ssn"))
        .when(is_kind("phone"), F.when(F.length(_digits(value)).between(7, 15), "phone"))
        .when(is_kind("card"), F.when(_is_card(value), "card"))
    )


def _pseudonym(found: Column, key: str) -> Column:
    value, kind = found["value"], found["kind"]
    return (
        F.when(kind.isNull(), value)
        .when(kind == "mail", _new_mail(value, key))
        .when(kind == "ip", _new_ip(value, key))
        .when(kind == "date", _new_date(value, key))
        .when(kind == "ssn", _fill(value, permute_digits(_digits(value), key, "ssn")))
        .when(kind == "phone", _new_phone(value, key))
        .otherwise(_new_card(value, key))
    )


def _is_card(value: Column) -> Column:
    return _let(_digits(value), lambda d: (_luhn(d) % 10 == 0) & (d.cast("decimal(38,0)") > 0))


def pseudonymize(docs: DataFrame, key: str = KEY, text: str = "text", found: str = "found") -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and an array ``found`` of (value, kind, pseudonym), in text order.

    Null and empty texts stay as they are with nothing found. ``value`` is
    plain personal data and only for review. A failed validation leaves the text
    as it is. Every row is answered on its own: nothing is shuffled.

    Each step is a column of its own, as nothing inside a lambda is shared: a
    pattern is run and a pseudonym made once for each place that needs it.
    """
    whole = F.col(f"`{text}`")
    # The cut is a mark that the text cannot hold, as its first character is escaped there.
    sign, escaped, cut = "\u0001", "\u0001\u0002", "\u0001\u0003"
    safe = F.replace(whole, F.lit(sign), F.lit(escaped))
    runs, parts, cards, made = (free_name(docs, n) for n in ("runs", "parts", "cards", "made"))
    # Runs that fail the validation go back into the text, to be part of other numbers there.
    marked = F.zip_with(F.split(safe, CARD, -1), F.col(runs), lambda gap, run: F.concat(gap, F.when(run.isNull(), "").when(run["valid"], cut).otherwise(run["value"])))
    texts = F.transform(F.split(F.array_join(marked, ""), cut, -1), lambda t: F.replace(t, F.lit(escaped), F.lit(sign)))
    join = lambda gaps, values: F.array_join(F.zip_with(gaps, values, lambda gap, x: F.concat(gap, F.coalesce(x["pseudonym"], F.lit("")))), "")
    known = lambda p: F.transform(p["values"], lambda v: F.struct(v.alias("value"), _kind(v).alias("kind")))
    named = lambda x: F.struct(x["value"].alias("value"), x["kind"].alias("kind"), _pseudonym(x, key).alias("pseudonym"))
    card = lambda r: F.struct(r["value"].alias("value"), F.lit("card").alias("kind"), _new_card(r["value"], key).alias("pseudonym"))
    steps = (
        docs.withColumn(runs, F.when(whole.rlike("[0-9]|@"), F.transform(F.regexp_extract_all(safe, F.lit(CARD), F.lit(0)), lambda r: F.struct(r.alias("value"), _is_card(r).alias("valid")))))
        .withColumn(parts, F.when(F.col(runs).isNotNull(), F.transform(texts, lambda t: F.struct(F.split(t, ANY, -1).alias("gaps"), F.regexp_extract_all(t, F.lit(ANY), F.lit(0)).alias("values")))))
        .withColumns({
            made: F.transform(parts, lambda p: F.struct(p["gaps"].alias("gaps"), F.transform(known(p), named).alias("values"))),
            cards: F.transform(F.filter(runs, lambda r: r["valid"]), card),
        })
    )
    listed = F.flatten(F.zip_with(made, cards, lambda m, c: F.concat(F.filter(m["values"], lambda x: x["kind"].isNotNull()), F.when(c.isNull(), F.array().cast(FOUND)).otherwise(F.array(c)))))
    joined = F.array_join(F.zip_with(made, cards, lambda m, c: F.concat(join(m["gaps"], m["values"]), F.coalesce(c["pseudonym"], F.lit("")))), "")
    return steps.withColumn(found, F.coalesce(listed, F.array().cast(FOUND))).withColumn(text, F.when(F.size(found) > 0, joined).otherwise(whole)).drop(runs, parts, cards, made)


def report(docs: DataFrame) -> DataFrame:
    """``doc_id``, the new text and how many values of each kind were replaced."""
    done = pseudonymize(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return done.select("doc_id", "text", *[count(k) for k in KINDS])


def rewrite(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and its length in ``n_chars``, if there is such a column; all else as it was."""
    mark = free_name(docs, "found")
    done = pseudonymize(docs, key, found=mark)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.size(mark) > 0, F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return done.drop(mark)
