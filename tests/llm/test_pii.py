from hypothesis import given, settings
from hypothesis import strategies as st

from candleworks.llm import pii

TEXT = (
    "Mail ann.55@mail3.example.com or +1 (017) 555-7713, card 4111 1111 1111 1111, 10.20.30.40, born 2024-02-29 "
    "or 12/31/1999, DE89 3704 0044 0532 0130 00, 123-45-6789, token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\""
)
VALUES = [
    "ann.55@", "017) 555-7713", "4111 1111", "10.20.30.40", "2024-02-29", "12/31/1999", "3704 0044", "123-45-6789", "04dbebab",
]


def test_every_kind_is_replaced_and_led_back():
    new, found = pii.Pseudonymiser().rewrite(TEXT)
    assert [k for k, _, _ in found] == ["email", "phone", "card", "ip", "date", "date", "iban", "national_id", "secret"]
    assert not [v for v in VALUES if v in new]
    assert pii.Pseudonymiser(back=True).rewrite(new)[0] == TEXT
    assert pii.Pseudonymiser(b"other key").rewrite(TEXT)[0] != new


def test_pseudonyms_are_valid_and_linked():
    one = pii.Pseudonymiser()
    new, found = one.rewrite("a 4111111111111111 b 4111-1111-1111-1111 c")
    digits = ["".join(c for c in new[s:e] if c.isdigit()) for _, s, e in found]
    assert digits[0] == digits[1] != "4111111111111111"
    assert pii.luhn_digit(digits[0][:-1]) == digits[0][-1]
    iban = one.rewrite("DE89370400440532013000")[0]
    assert pii.iban_check(iban[:2], iban[4:]) == iban[2:4]
    assert one.rewrite("x me@a.org y")[0].split()[1] == one.rewrite("me@a.org")[0]


def test_invalid_values_stay():
    one = pii.Pseudonymiser()
    for text in ("4111111111111112", "300.1.1.1", "2023-02-29", "000-12-3456", "version 2.0", "1.2.3", "a@b", "", None, "12 34"):
        assert one.rewrite(text) == (text, [])


@settings(max_examples=200, deadline=None)
@given(st.integers(2, 10**18), st.integers(0), st.binary(max_size=4))
def test_permutation_has_an_inverse_and_no_fixed_point(size, x, label):
    p = pii.Permutation()
    x %= size
    y = p.pseudonym(x, size, label)
    assert 0 <= y < size and y != x and p.original(y, size, label) == x


def test_small_permutations_are_whole():
    p = pii.Permutation()
    for size in (2, 3, 10, 97):
        assert sorted(p.pseudonym(x, size, b"l") for x in range(size)) == list(range(size))


@settings(max_examples=100, deadline=None)
@given(st.dates(min_value=pii.dt.date(1900, 1, 1), max_value=pii.dt.date(2099, 12, 31)), st.sampled_from(["%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y"]))
def test_dates_round_trip(day, form):
    text = day.strftime(form).replace(day.strftime("%Y"), f"{day.year:04d}")
    new = pii.Pseudonymiser().rewrite(text)[0]
    assert new != text and pii.Pseudonymiser(back=True).rewrite(new)[0] == text


def test_documents_keep_their_columns(documents, awkward):
    docs = documents(awkward + [TEXT, TEXT])
    out = pii.pseudonymised(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    rows = out.collect()
    assert [r.text for r in rows[: len(awkward)]] == awkward
    assert rows[-1].text == rows[-2].text != TEXT and rows[-1].n_chars == len(rows[-1].text)
    assert pii.pseudonymised(documents([])).count() == 0


def test_values_with_more_digits_or_words_behind_them():
    one = pii.Pseudonymiser()
    for text, value, kind in (
        ("card 4111 1111 1111 1111 12/27", "4111 1111 1111 1111", "card"),
        ("card 4111 1111 1111 1111 123 x", "4111 1111 1111 1111", "card"),
        ("card 4111-1111-1111-1111-12", "4111-1111-1111-1111", "card"),
        ("pay BE68 5390 0754 7034 EUR", "BE68 5390 0754 7034", "iban"),
        ("pay DE89 3704 0044 0532 0130 00 BY 10.20.30.40", "DE89 3704 0044 0532 0130 00", "iban"),
        ("at 2024-02-29T10:00:00Z", "2024-02-29", "date"),
    ):
        start, (new, found) = text.index(value), one.rewrite(text)
        assert found[0] == (kind, start, start + len(value)) and new[start : start + len(value)] != value
        if "10.20" not in text:
            assert new[start + len(value) :] == text[start + len(value) :]
        else:
            assert [k for k, _, _ in found] == ["iban", "ip"]
    for text in ("2024-02-29Tx", "2024-02-29T1", "4111 1111 1111 1112 12/27", "4111111111111112"):
        assert one.rewrite(text) == (text, [])
