import pytest

from tallyline.llm import pseudonyms

#: A value, what stands behind it, and the kind.
BESIDE = [
    ("BE68539007547034", " EUR 100", "iban"),
    ("AT611904300234573201", " BIC", "iban"),
    ("ES91 2100 0418 4502 0005 1332", " IS", "iban"),
    ("NL91ABNA0417164300", " 2024", "iban"),
    ("SE45 5000 0000 0583 9825 7466", " SEK 9", "iban"),
    ("DE89 3704 0044 0532 0130 00", " 12", "iban"),
    ("BE68539007547034", " AT611904300234573201", "iban"),
    ("+44 20 7946 0958", " 2024", "phone"),
    ("+44 (0)20 7946 0958", " 2024", "phone"),
    ("+49 30 1234567", " 2024", "phone"),
    ("+999 20 7946 0958 12", " 2024", "phone"),
    ("+33 1 42 68 53 00", " 12", "phone"),
]


@pytest.fixture(scope="module")
def hidden(spark):
    texts = [t for v, after, _ in BESIDE for t in (v, v + after, f"see {v}, then")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = pseudonyms.pseudonymised(docs).collect()
    back = pseudonyms.pseudonymised(spark.createDataFrame([(r.doc_id, r.text) for r in out], "doc_id long, text string"), restore=True)
    assert {r.doc_id: r.text for r in back.collect()} == dict(enumerate(texts))
    return {texts[r.doc_id]: r for r in out}


@pytest.mark.parametrize(("value", "after", "kind"), BESIDE)
def test_a_value_does_not_take_in_what_stands_beside_it(hidden, value, after, kind):
    alone, beside = hidden[value].found, hidden[value + after].found
    assert [f.kind for f in alone] == [kind] and alone[0].pseudonym != value and beside[0] == alone[0]
    if after != " AT611904300234573201":
        assert beside == alone and hidden[value + after].text == alone[0].pseudonym + after
    else:
        assert [f.kind for f in beside] == ["iban", "iban"]
    assert hidden[f"see {value}, then"].found == alone
