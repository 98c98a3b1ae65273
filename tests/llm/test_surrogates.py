import re

from corpus_cases import ODD
from pyspark.sql import functions as F

from gleanery.llm import queries, surrogates

KEY = b"a test key"


def kinds(text):
    return [(text[a:b], kind) for a, b, kind, _ in surrogates.find(text)]


def test_entities():
    text = (
        "Mrs. Anna Schmidt met Dr. Schmidt; mail ANNA.S@Example.org, 4111 1111 1111 1111 or 4111-1111-1111-1111, 078-05-1120, "
        "DE89370400440532013000, (212) 555-1234, +1 (743) 555-3824, +44 20 7946 0958, 10.0.0.1"
    )
    assert kinds(text) == [
        ("Anna", "given_f"), ("Schmidt", "surname"), ("Schmidt", "surname"), ("ANNA.S@Example.org", "email"),
        ("4111 1111 1111 1111", "card"), ("4111-1111-1111-1111", "card"), ("078-05-1120", "ssn"),
        ("DE89370400440532013000", "iban"), ("(212) 555-1234", "phone"), ("+1 (743) 555-3824", "phone"),
        ("+44 20 7946 0958", "phone"), ("10.0.0.1", "ip"),
    ]
    assert kinds("Version 2.0 of 2024-01-02, page 12, 1.2.3.4.5, 300.1.1.1, a@b, 12 345 678") == []


def test_forms_of_phone_numbers():
    forms = (
        "+33 6 12 34 56 78", "1-800-555-0199", "1.212.555.0199", "(800)-555-0199", "8005550199", "18005550199",
        "1 (800) 555-0199", "030 1234567", "(030) 12345678", "030/1234567", "06 12 34 56 78", "06.12.34.56.78",
        "0612345678", "0044 20 7946 0958", "020 7946 0958", "612 34 56 78", "91 123 45 67", "800-555-0199",
    )
    for form in forms:
        for a, b in (("call ", " now"), ("(", ")"), ("", "."), ("x", "x")):
            [(start, end, kind, normal)] = surrogates.find(a + form + b)
            assert ((a + form + b)[start:end], kind) == (form, "phone")
            for attempt in range(20):
                new = surrogates.spelled("phone", form, drawn := surrogates.draw(KEY, "phone", normal, attempt))
                assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", form)
                assert [(x[2], x[3]) for x in surrogates.find(a + new + b)] == [("phone", drawn)], (form, new)
    same = ("+1 800 555 0199", "1-800-555-0199", "(800)-555-0199", "8005550199")
    assert {surrogates.find(x)[0][3] for x in same} == {"+18005550199"}
    assert surrogates.find("0044 20 7946 0958")[0][3] == surrogates.find("+44 20 7946 0958")[0][3]
    assert kinds("+33 6 12 34 56 78 4111 1111 1111 1111") == [("+33 6 12 34 56 78", "phone"), ("4111 1111 1111 1111", "card")]
    assert kinds("+44 20 794 609 581 220 100 200")[0] == ("+44 20 794 609 581 22"[:18], "phone")
    assert kinds("on 01.02.2024, 01/02/2024, 01-02-2024 10:30, 0.1234567, 1600000000, 2024-01-02 03:04:05") == []


def test_entities_next_to_other_characters():
    for mark in ("", ".", "-", "#", "x", "(", "="):
        for value, kind in (("4785380592391139", "card"), ("078-05-1120", "ssn"), ("+1 (771) 555-1655", "phone")):
            assert kinds(f"ab{mark}{value}{mark} cd") == [(value, kind)], (mark, value)
    assert kinds("THAT.92@MAIL2.EXAMPLE.COM###!!233.233.171.252!!") == [
        ("THAT.92@MAIL2.EXAMPLE.COM", "email"), ("233.233.171.252", "ip")
    ]


def test_every_mention_of_a_name():
    cases = {
        "Mr. John Miller called. Miller paid; John left, MILLER's bill too.": "John Miller Miller John MILLER",
        "Anna Schmidt? Frau Dr. Schmidt's Hund": "Schmidt Schmidt",
        "Mr. John Q. Smith and Smith": "John Smith Smith",
        "Mr. J. R. Smith I know Mr. J.R. Smith Jr.": "Smith Smith",
        "Mr. John Mr. Miller. Mr Dr": "John Miller",
        "Mr. John@x.org and Mr. John, John@x.org": "John@x.org John John@x.org",
        "Dr. Maria Garcia Lopez; Lopez-Garcia": "Maria Garcia Lopez Lopez Garcia",
        "Mr.  Miller, Mr.\nJones. He met Mrs O’Brien": "Miller Jones O’Brien",
        "Mr. Ludwig van Beethoven, Mr. Ludwig": "Ludwig Beethoven Ludwig",
        "Dear Mr. Brown\nThe brown dog of Brownie, brown@x.org": "Brown brown@x.org",
    }
    for text, want in cases.items():
        assert [x for x, _ in kinds(text)] == want.split(), text
    entities = surrogates.find("Mr. John Miller met Dr. John Miller, Mr. John and John.")
    assert {(kind, normal) for _, _, kind, normal in entities} == {("given_m", "john"), ("surname", "miller")}


def test_no_later_mention_survives(spark):
    docs = spark.createDataFrame([(1, "Mr. John Miller called. Miller paid; John left.")], "doc_id long, text string")
    [row] = surrogates.replaced(docs, KEY).collect()
    given, surname = re.match(r"Mr\. (\w+) (\w+) called", row.text).groups()
    assert row.text == f"Mr. {given} {surname} called. {surname} paid; {given} left." and row.n_entities == 4
    assert not {"John", "Miller"} & {given, surname}


def test_draws_keep_type_and_format():
    for attempt in range(8):  # later draws of names and addresses grow longer
        card = surrogates.draw(KEY, "card", "4111111111111111", attempt)
        assert len(card) == 16 and card[0] == "4" and surrogates.luhn(card) == 0
        iban = surrogates.draw(KEY, "iban", "DE89370400440532013000", attempt)
        assert iban[:2] == "DE" and len(iban) == 22 and surrogates.iban_valid(iban)
        assert re.fullmatch(surrogates.IP, surrogates.draw(KEY, "ip", "8.8.4.4", attempt))
        phone = surrogates.draw(KEY, "phone", "+17435553824", attempt)
        assert re.fullmatch(r"\+1[2-9]\d{9}", phone)
        assert surrogates.spelled("phone", "+1 (743) 555-3824", phone)[:4] == "+1 ("
        assert re.fullmatch(r"[a-z]{3}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com", surrogates.draw(KEY, "email", "abc.12@mail5.example.com", attempt))
        assert surrogates.draw(KEY, "given_f", "anna", attempt).endswith("a")
        assert surrogates.script_of(surrogates.draw(KEY, "surname", "иванова", attempt)) == "CYRILLIC"
    assert len(surrogates.draw(KEY, "email", "ab@c.org", 8)) > len("ab@c.org")
    assert surrogates.draw(KEY, "card", "4111111111111111", 0) != surrogates.draw(b"other", "card", "4111111111111111", 0)
    assert surrogates.spelled("surname", "SCHMIDT", "kalo") == "KALO"


def test_corpus(spark):
    rows = [
        (1, "Mr. John Miller, 4111 1111 1111 1111"),
        (2, "call Mr Miller or Mrs. Mary Miller at +1 (743) 555-3824"),
        (3, "4111111111111111 and +17435553824 and +1 743 555 3824"),
        (4, "nothing here"),
        (4, "x@y.org"),
        (None, "x@y.org"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = surrogates.replaced(docs, KEY).collect()
    texts = [r.text for r in got]
    joined = "\n".join(texts)
    for secret in ("Miller", "John", "Mary", "4111111111111111", "4111 1111", "555-3824", "x@y.org"):
        assert secret not in joined
    assert "nothing here" in texts
    one, two, three = (next(r.text for r in got if r.doc_id == i) for i in (1, 2, 3))
    assert re.search(r"[\d ]{19}$", one)[0].replace(" ", "") == three.split()[0]
    digits = re.sub(r"\D", "", re.search(r"\+.*", two)[0])
    assert three.split()[2] == "+" + digits and re.sub(r"\D", "", three.split("and")[2]) == digits
    surname = re.search(r"Mr\. \w+ (\w+)", one)[1]
    assert f"Mr {surname} or" in two and re.search(rf"Mrs\. \w+a {surname} ", two)
    assert len({r.text for r in got if r.text and "@" in r.text}) == 1


def test_collisions_are_drawn_again(spark, monkeypatch):
    """With a draw of few values all entities still get surrogates of their own, none of them an original."""
    entities = spark.createDataFrame([("ip", f"{i:02d}") for i in range(10)] * 3, "kind string, normal string")

    def drawn(frame, key):
        crowded = F.lpad(((F.col("normal").cast("int") / 3).cast("int") + F.col("attempt")).cast("string"), 2, "0")
        return frame.withColumn("surrogate", crowded)

    monkeypatch.setattr(surrogates, "drawn", drawn)
    got = {r.normal: r.surrogate for r in surrogates.assign(entities, KEY).collect()}
    assert len(got) == 10 and len(set(got.values())) == 10 and not set(got) & set(got.values())


def test_odd_rows(odd, empty):
    got = surrogates.replaced(odd, KEY)
    assert got.columns == [*odd.columns, "n_entities"]
    rows = got.collect()
    plain = lambda t: t is None or not surrogates.find(t)
    assert sorted(r.text or "" for r in rows if not r.n_entities) == sorted(t or "" for _, t in ODD if plain(t))
    assert [r.text for r in rows if r.n_entities] != [t for _, t in ODD if not plain(t)]
    assert sum(r.text is None for r in rows) == 2
    assert surrogates.replaced(empty, KEY).count() == 0


def test_query(spark, sf_dir, texts):
    got = {r.doc_id: r for r in queries.op4_surrogates(spark, sf_dir).collect()}
    mapped = {}
    for doc_id, text in texts:
        found, new = surrogates.find(text or ""), got[doc_id].text
        assert got[doc_id].n_entities == len(found)
        if not found:
            assert new == text
        for a, b, kind, normal in found:
            assert text[a:b] not in new
        for (_, _, kind, normal), (_, _, kind2, normal2) in zip(found, surrogates.find(new or "")):
            assert kind == kind2
            assert mapped.setdefault((kind, normal), normal2) == normal2
    assert len(set(mapped.items())) == len({(k, v) for (k, _), v in mapped.items()})
