"""Pseudonyms: formats and validity kept, equal values linked, permutations without collisions."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.llm import pii


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(digits)) % 10 == 0


def shape(text):
    return "".join("9" if c.isdigit() else c for c in text)


def found(spark, *texts):
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id bigint, text string, kind string")
    return pii.pseudonymize(df).orderBy("doc_id").collect()


def test_formats_and_links(spark):
    text = "card 4845168114407329 or 4845-1681-1440-7329, bad 9807915762804490, call +1 (487) 555-7209, ip 97.51.17.173, ssn 219-09-9999."
    one, two = found(spark, text, "again 4845 1681 1440 7329 and (487) 555-7209 at 97.51.17.173")
    kinds = [x.kind for x in one.found]
    assert kinds == ["card", "card", "phone", "ip", "ssn"]
    assert all(shape(x.value) == shape(x.pseudonym) for x in one.found if x.kind != "ip")
    cards = {"".join(c for c in x.pseudonym if c.isdigit()) for r in (one, two) for x in r.found if x.kind == "card"}
    assert len(cards) == 1 and luhn(cards.pop()) and "9807915762804490" in one.text
    assert [x.pseudonym for x in two.found][1][-8:] == [x.pseudonym for x in one.found][2][-8:]
    assert [x.pseudonym for x in two.found][2] == one.found[3].pseudonym
    for x in one.found:
        assert x.value not in one.text
    assert all(0 <= int(o) <= 255 for o in one.found[3].pseudonym.split("."))


def test_dates_stay_valid_and_linked(spark):
    one, two = found(spark, "2001-02-28, 28.02.2001, 28/02/2001 02/28/2001", "31.02.2001 0000-01-01 1.2.3 2001-13-01 v1.2.2001.3")
    assert [x.kind for x in one.found] == ["date"] * 4 and not two.found
    iso, dots, slashes, american = (x.pseudonym for x in one.found)
    day = dt.date.fromisoformat(iso)
    assert dots == day.strftime("%d.%m.%Y") and slashes == day.strftime("%d/%m/%Y")
    assert american in (day.strftime("%m/%d/%Y"),) and 2000 <= day.year <= 2099


def test_days_are_permuted(spark):
    days = spark.range(36525).select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    made = days.select("d", pii.permute_days(F.col("d"), "k").alias("p"))
    assert made.select("p").distinct().count() == 36525
    assert made.where("year(p) not between 2000 and 2099").count() == 0
    assert made.where("d = p").count() < 20


def test_digits_are_permuted(spark):
    every = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("d"))
    made = every.select(pii.permute_digits(F.col("d"), "k", "t").alias("p"))
    assert made.distinct().count() == 10_000 and made.where("length(p) <> 4").count() == 0
    odd = every.select(pii.permute_digits(F.substring("d", 1, 3), "k", "t").alias("p"))
    assert odd.distinct().count() == 1000 and odd.where("length(p) <> 3").count() == 0
    keys = every.select(pii.permute_digits(F.col("d"), "other", "t").alias("p"))
    assert keys.collect() != made.collect()


def test_mail(spark):
    one, two = found(spark, "to die.55@mail4.example.com, Die.55@Mail4.example.com.", "x@mail4.example.com y@z")
    names = [x.pseudonym for x in one.found + two.found]
    assert names[0] == names[1] != names[2] and names[0].split("@")[1] == names[2].split("@")[1] and len(names) == 3
    assert "mail4" not in one.text and "y@z" in two.text


def test_cards_beside_numbers(spark):
    card, other, spaced, amex = "4111111111111111", "7536784127813050", "4845 1681 1440 7329", "3782 822463 10005"
    texts = [
        f"{card} 12/27", f"order 12 {card}", f"{card} 2024", f"{other} 4845168114407329", f"{spaced} 123", f"1234 {spaced}", f"{spaced} {spaced}",
        f"{amex} 1234", f"{card} 2024-05-01", f"{card}-219-09-9999", f"{card} +1 (487) 555-7209", f"\u0001{card}\u0001\u0003 12", "48451681144 07329",
    ]
    rows = found(spark, *texts)
    kinds = [[x.kind for x in r.found] for r in rows]
    assert kinds == [["card"]] * 3 + [["card"] * 2] + [["card"]] * 2 + [["card"] * 2, ["card"], ["card", "date"], ["card"], ["card", "phone"], ["card"], ["card"]]
    for text, r in zip(texts, rows):
        left = text
        for x in r.found:
            assert x.kind != "card" or luhn(x.pseudonym)
            left = left.replace(x.value, x.pseudonym)
        assert r.text == left and card not in r.text and spaced not in r.text
    assert len({x.pseudonym for r in rows for x in r.found if x.value == card}) == 1


def test_mail_with_a_card_number_stays_a_mail(spark):
    rows = found(spark, "4111111111111111@x.example.com", "4111111111111111.a@x.example.com", "a@4111111111111111.com")
    assert [[x.kind for x in r.found] for r in rows] == [["mail"]] * 3


def test_phones_link_in_every_spelling(spark):
    rows = found(spark, "+1 555 123 4567", "555-123-4567", "(555) 123-4567", "+15551234567", "+1-555-123-4567", "+44 20 7946 0958", "+442079460958", "+353 87 679 9000")
    assert all([x.kind for x in r.found] == ["phone"] for r in rows)
    digits = ["".join(c for c in r.text if c.isdigit()) for r in rows]
    assert digits[0] == digits[3] == digits[4] == "1" + digits[1] == "1" + digits[2] and digits[5] == digits[6]
    assert [r.text[:4] for r in rows[5:]] == ["+44 ", "+44" + digits[6][2], "+353"]
    assert all(shape(x.value) == shape(x.pseudonym) for r in rows for x in r.found)


def test_octets_keep_their_format(spark):
    assert [[x.kind for x in r.found] for r in found(spark, "010.1.1.1", "01.1.1.1", "10.0.0.255 256.1.1.1")] == [[], [], ["ip"]]


def test_odd_rows(spark):
    texts = [None, "", "no numbers at all", "4.0. 3. 555-7209", "97.51.17.173 " * 3000, "9" * 60, "999.1.1.1 0.0.0.0.0", "a" * 200_000, "a.b-" * 40_000 + "@ x"]
    rows = found(spark, *texts)
    assert [r.text for r in rows][:4] == texts[:4] and [r.text for r in rows][5:] == texts[5:]
    assert len(rows[4].found) == 3000 and len(set(rows[4].text.split())) == 1


def test_rewrite_keeps_the_columns(spark):
    df = spark.createDataFrame([(1, "ip 97.51.17.173", 15, "a"), (1, "ip 97.51.17.173", 15, "a"), (2, "plain", 99, None), (None, None, None, None)], "doc_id bigint, text string, n_chars bigint, _found string")
    out = pii.rewrite(df)
    assert out.columns == df.columns and out.count() == 4
    rows = out.where("doc_id = 1").collect()
    assert rows[0] == rows[1] and rows[0].n_chars == len(rows[0].text)
    assert pii.rewrite(df.limit(0)).collect() == []
