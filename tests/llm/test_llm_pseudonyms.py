"""Format-preserving pseudonyms."""

import base64
import datetime
import random
import re
import time

import pytest
from hypothesis import given, settings, strategies as st

from llm_cases import documents, empty
from tidewell.llm import pseudonyms as P

KEY = b"key"
STEP, BACK = P._steps(KEY, False), P._steps(KEY, True)
VALUES = [
    "4785380592391139", "4111 1111 1111 1111", "378282246310005", "+1 (499) 555-6503", "555-123-4567", "+49 30 901820",
    "152.143.123.131", "123-45-6789", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "rhokk.73@mail2.example.com",
    "2024-02-29", "31.12.1999", "12/31/1999",
]


def shape(text):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", text)))


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1000])
def test_permutation(n):
    image = [P.permute(v, n, KEY, "t") for v in range(n)]
    assert sorted(image) == list(range(n))
    assert [P.permute(v, n, KEY, "t", True) for v in image] == list(range(n))
    assert n < 100 or image != [P.permute(v, n, b"other", "t") for v in range(n)]


@pytest.mark.parametrize("value", VALUES)
def test_values_change_within_their_format_and_back(value):
    fresh, counts = P.pseudonymise(f"a {value}, b {value}", STEP)
    assert sum(counts.values()) == 2 and value not in fresh
    one, two = re.fullmatch(r"a (.*), b (.*)", fresh).groups()
    assert one == two and (shape(one) == shape(value) or "." in value and value.count(".") == 3)
    assert P.pseudonymise(fresh, BACK)[0] == f"a {value}, b {value}"
    assert P.pseudonymise(one, STEP)[1] == P.pseudonymise(value, STEP)[1]


@pytest.mark.parametrize("text", [
    "4785380592391138", "192.168.1.256", "1.2.3.4.5", "000-12-1234", "2023-02-29", "GB83 WEST 1234 5698 7654 32", "123456",
    "", "no values here", "31.13.1999",
])
def test_invalid_values_stay(text):
    assert P.pseudonymise(text, STEP) == (text, {})


@pytest.mark.parametrize("value, rest", [
    ("4111 1111 1111 1111", " 12/26"), ("4111111111111111", " 737"), ("4111-1111-1111-1111", "-737"),
    ("378282246310005", " 2024-02-29"), ("DE89370400440532013000", " BIC COBADEFFXXX"),
    ("DE89 3704 0044 0532 0130 00", " COBADEFFXXX"), ("GB82 WEST 1234 5698 7654 32", " MIDLGB22"),
])
def test_a_number_ends_before_what_follows_a_separator(value, rest):
    text = f"pay {value}{rest} now"
    fresh, counts = P.pseudonymise(text, STEP)
    kind = "iban" if value[0].isalpha() else "card"
    assert counts[kind] == 1 and value not in fresh and shape(fresh) == shape(text)
    assert P.pseudonymise(fresh[4 : 4 + len(value)], STEP)[1] == {kind: 1}
    assert P.pseudonymise(fresh, BACK)[0] == text


def test_cards_beside_other_digits_are_masked_whole_and_come_back():
    for k in range(400):
        payload = f"4{(k * 987654321987) % 10**14:014d}"
        card = payload + P.luhn_digit(payload)
        card = " ".join(card[i : i + 4] for i in range(0, 16, 4))
        for text in (f"{card} {k % 90 + 10}/26", f"{card} {k % 900 + 100}", f"{k % 90 + 10} {card}"):
            fresh, counts = P.pseudonymise(text, STEP)
            assert counts == {"card": 1} and card not in fresh
            assert P.pseudonymise(fresh, BACK)[0] == text


def test_results_are_valid():
    for k in range(300):
        payload = f"{(k * 987654321987) % 10**15:015d}"
        fresh, counts = P.pseudonymise(payload + P.luhn_digit(payload), STEP)
        assert counts == {"card": 1} and P.luhn_digit(fresh[:-1]) == fresh[-1]
        day = (datetime.date(1990, 1, 1) + datetime.timedelta(k * 37)).isoformat()
        datetime.date.fromisoformat(P.pseudonymise(day, STEP)[0])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*VALUES, " ", ",", "x", "7", ".", "\n", "é"]), max_size=12))
def test_any_mixture_is_safe(parts):
    text = " ".join(parts)
    fresh, counts = P.pseudonymise(text, STEP)
    assert isinstance(fresh, str) and (counts or fresh == text)


def test_edges(spark):
    found = {r["doc_id"]: r for r in P.mask(documents(spark), KEY).collect()}
    assert found[1]["text"] is None and found[2]["text"] == "" and found[1]["n_found"] == 0
    assert P.mask(empty(spark), KEY).count() == 0
    with pytest.raises(ValueError):
        P.mask(empty(spark), b"")


def test_equal_values_stay_linked_across_rows(spark):
    rows = spark.createDataFrame([(i, f"{i} call +1 (499) 555-6503 now") for i in range(20)], "doc_id long, text string")
    masked = P.mask(rows.repartition(7), KEY)
    assert len({r["text"].split("+")[1] for r in masked.collect()}) == 1
    back = P.mask(masked.select("doc_id", "text"), KEY, backward=True)
    assert sorted(r["text"] for r in back.collect()) == sorted(r["text"] for r in rows.collect())


def test_a_megabyte_without_blanks_takes_linear_time():
    letters = base64.b64encode(random.Random(3).randbytes(750_000)).decode().replace("/", "x")
    begin = time.perf_counter()
    assert P._next_find(letters + " ..bob@example.com", 0, lambda value, n, tweak: value)[1] >= len(letters)
    assert time.perf_counter() - begin < 20
