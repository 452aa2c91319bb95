"""Surrogates: what is found, what stays, distinctness and coreference."""

import itertools
import re

from weftline.llm import surrogates
from weftline.llm.common import table

KEY = "k"


def test_permutations_are_one_to_one():
    p = surrogates.Permuter(b"x")
    for n in (1, 2, 3):
        every = ["".join(x) for x in itertools.product("0123456789", repeat=n)]
        assert sorted(p.letters(x, "0123456789", "t") for x in every) == every
    every = ["".join(x) for x in itertools.product("ab1", repeat=3)]
    assert len({p.pattern(x, "t") for x in every}) == len(every)
    assert re.fullmatch(r"[A-Z][a-z]{3}\.\d\d", p.pattern("John.42", "t"))


def test_kinds_keep_their_format():
    s = surrogates.Surrogates(KEY)
    text = (
        "Write to John.Doe+x7@Mail5.example.com or J@corp.de. Call +1 (499) 555-6503 or 499-555-6503! Card 4111 1111 1111 1111, "
        "not 4111111111111112. IBAN DE89 3704 0044 0532 0130 00. From 10.0.0.7 and 8.8.8.8. SSN 123-45-6789. Mrs. Anna Smith and "
        "Herr Müller met Господин Иванов. Version 2.0.1.4.5 and 16 digits."
    )
    new, kinds = s.replace(text)
    assert sorted(kinds) == sorted(
        ["email", "email", "phone", "phone", "card", "iban", "ip", "ip", "ssn", "person", "person", "person", "person"]
    )
    for gone in ("John.Doe", "J@corp", "555-6503", "4111 1111 1111 1111", "0532 0130", "10.0.0.7", "8.8.8.8", "123-45-6789", "Anna", "Smith", "Müller", "Иванов"):
        assert gone not in new
    assert "4111111111111112" in new and "Version 2.0.1.4.5" in new and ".example.com" in new and ".de.example" in new
    found = s.find(new)
    assert sorted(k for _, _, k, _ in found) == sorted(kinds)  # surrogates are of their type: check digits hold
    assert re.search(r"Mrs\. [A-Z]\w+(a|ina|ela) [A-Z]\w+ and Herr [A-Z]\w+ met Господин [А-Я][а-я]+\.", new)
    private = [x for x in re.findall(r"\d+\.\d+\.\d+\.\d+", new) if surrogates._host_bits([int(p) for p in x.split(".")]) < 32]
    assert len(private) == 1 and private[0].startswith("10.")


def test_one_entity_one_surrogate():
    s = surrogates.Surrogates(KEY)
    assert s.email("A.B@x.com").lower() == s.email("a.b@X.COM").lower()
    assert re.sub(r"\D", "", s.card("4111-1111-1111-1111")) == s.card("4111111111111111")
    assert re.sub(r"\D", "", s.phone("+1 (499) 555-6503")) == re.sub(r"\D", "", s.phone("+1-499-555-6503"))
    assert s.name("family", "", "SMITH") == s.name("family", "", "Smith").upper()
    assert surrogates.Surrogates("other").email("a@x.com") != s.email("a@x.com")
    emails = [f"{a}{b}@{d}.com" for a in "abc" for b in range(40) for d in ("x", "y")]
    assert len({s.email(e) for e in emails}) == len(emails)


def test_names_that_meet_move_on(spark):
    # with no syllables only 14 * 3 names exist for a gender: many meet at first
    names = ["".join(x).capitalize() for x in itertools.product("bcd", "aei", "xyz")][:25]
    docs = spark.createDataFrame([(i, f"Mr. {n}") for i, n in enumerate(names)], "doc_id long, text string")
    rows = surrogates.with_surrogates(docs, KEY, syllables=0).collect()
    got = [r.text.split()[1] for r in rows]
    assert len(set(got)) == len(names) and not set(got) & set(names)
    assert {r.n_person for r in rows} == {1}


def test_rows_and_query(spark):
    rows = [(1, None, "x", 1), (1, "", "x", 2), (2, "a@b.com", None, 3), (2, "a@b.com", None, 3), (None, "8.8.8.8 " * 5000, "y", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_email long")
    got = surrogates.with_surrogates(docs, KEY).collect()
    assert len(got) == 5 and sorted(r.n_email for r in got) == [0, 0, 0, 1, 1] and sum(r.n_ip for r in got) == 5000
    assert len({r.text for r in got if r.doc_id == 2}) == 1 and [r.text for r in got if r.text is None] == [None]
    assert surrogates.with_surrogates(docs.limit(0), KEY).collect() == []
    sf = "/root/testdata/sf0.01"
    old = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    new = {r.doc_id: r for r in surrogates.op6_surrogates(spark, sf).collect()}
    assert old.keys() == new.keys()
    entity = re.compile(r"[\w.+-]+@[\w.-]+\w|\+1 \(\d{3}\) \d{3}-\d{4}|\b(?:\d{1,3}\.){3}\d{1,3}\b")
    pairs = {}
    for i, text in old.items():
        found = entity.findall(text)
        assert not set(found) & set(entity.findall(new[i].text))
        assert len(found) == new[i].n_email + new[i].n_phone + new[i].n_ip
        for a, b in zip(found, entity.findall(new[i].text), strict=True):
            assert pairs.setdefault(a.lower(), b.lower()) == b.lower()
        if not sum(new[i][f"n_{k}"] for k in surrogates.KINDS):
            assert text == new[i].text
    assert len(pairs) > 20 and len(set(pairs.values())) == len(pairs)


def test_later_mentions_and_one_surrogate_a_name(spark):
    rows = [
        (1, "Keller rang. Mrs. Anna Keller called. Keller said: KELLER's kellers, Anna-Lena and Kellermann stay. keller too."),
        (2, "Dr. Anna Keller and Anna"), (3, "my name is Anna"), (4, "Keller and Anna without a title"),
        (5, "Herr Kim-Lee Braun met Kim-Lee and Braun-Kim"), (6, "Mr. Sasha Ott and Mrs. Sasha Ott"),
    ]
    got = {r.doc_id: r for r in surrogates.with_surrogates(spark.createDataFrame(rows, "doc_id long, text string"), KEY).collect()}
    first = re.fullmatch(
        r"(\w+) rang\. Mrs\. (\w+) (\w+) called\. (\w+) said: (\w+)'s kellers, (\w+)-Lena and Kellermann stay\. keller too\.", got[1].text
    )
    keller, anna = first[3], first[2]
    assert first[1] == first[4] == keller != "Keller" and first[5] == keller.upper() and first[6] == anna != "Anna"
    assert anna.endswith(("a", "ina", "ela")) and got[1].n_person == 6
    assert got[2].text == f"Dr. {anna} {keller} and {anna}" and got[3].text == f"my name is {anna}"
    assert got[4].text == rows[3][1]
    five = re.fullmatch(r"Herr (\w+-\w+) (\w+) met (\w+-\w+) and (\w+)-Kim", got[5].text)
    assert five[1] == five[3] and five[2] == five[4] != "Braun"
    six = re.fullmatch(r"Mr\. (\w+) (\w+) and Mrs\. (\w+) (\w+)", got[6].text)
    assert six[1] == six[3] and six[2] == six[4]


def test_digits_of_all_scripts():
    s = surrogates.Surrogates(KEY)
    plain = {
        "email": "a7.b42@mail5.com", "iban": "DE89 3704 0044 0532 0130 00", "card": "4111 1111 1111 1111", "ip": "8.8.4.204",
        "ssn": "123-45-6789", "phone": "+966 50 123 4567",
    }
    for zero in "٠۰०０𝟎":
        put = str.maketrans({str(d): chr(ord(zero) + d) for d in range(10)})
        for kind, text in plain.items():
            new, kinds = s.replace(f"see {text.translate(put)}.")
            assert kinds == [kind]
            assert new == s.replace(f"see {text}.")[0].translate(put) != f"see {text.translate(put)}."
            assert [k for _, _, k, _ in s.find(new)] == [kind]
    mixed = s.replace("+٩٦٦ 50 ١٢٣ 4567")[0]
    assert re.fullmatch(r"\+٩٦٦ [0-9]{2} [٠-٩]{3} [0-9]{4}", mixed)


def test_numbers_next_to_other_groups():
    s = surrogates.Surrogates(KEY)
    card, amex, iban, norway = "4111 1111 1111 1111", "3782 822463 10005", "BE68 5390 0754 7034", "NO93 8601 1117 947"
    texts = [
        f"Card {card} 05/27", f"Card {card} 123", f"Card {card} 12.50 paid", f"Card {card.replace(' ', '-')}-05 x", f"Card {amex} 1234 05/27",
        f"No 12 {card}", f"No 2024 {card} 05/27", f"{card} 5555 5555 5555 4444 12", f"٤١١١ ١١١١ ١١١١ ١١١١ ٠٥/٢٧",
    ]
    for text in texts:
        new, kinds = s.replace(text)
        assert kinds == ["card"] * (2 if "5555" in text else 1), text
        if text.startswith("Card 4"):
            assert new.replace("-", " ") == text.replace("-", " ").replace(card, s.card(card))
    assert s.replace(texts[-2])[0] == f"{s.card(card)} {s.card('5555 5555 5555 4444')} 12"
    for text in (f"{iban} ABCD", f"AB12 {iban} ABCD EFGH", f"{norway} AB", f"{iban} {norway}", f"{iban} 12"):
        new, kinds = s.replace(text)
        assert kinds == ["iban"] * (text.count(iban) + text.count(norway)), text
        assert new == text.replace(iban, s.iban(iban)).replace(norway, s.iban(norway))
    phones = "499-555-6503 499-555-6504 and 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20"
    assert s.replace(phones)[1] == ["phone", "phone"]
    assert s.replace("1" * 100_000 + " " + "5 " * 100_000)[1] == []


def test_what_is_replaced_differs_in_every_script():
    s = surrogates.Surrogates(KEY)
    locals_ = ["محمد", "山田太郎", "Łukasz.Żółć", "дмитрий", "νίκος", "דוד", "สมชาย", "김철수", "अमर", "ა", "é", "a", "7"]
    for local in locals_:
        for text in (f"{local}@example.com", f"{local.upper()}@Example.com", f"{local}@{local}.org"):
            new, kinds = s.replace(f"to {text} now")
            assert kinds == ["email"], text
            old, got = text.split("@")[0], new[3:-4].split("@")[0]
            assert got != old and len(got) == len(old)
            for a, b in zip(old, got, strict=True):
                assert a.isalnum() == b.isalnum() and a.isupper() == b.isupper() and a.isdecimal() == b.isdecimal()
            # letters of lists are exchanged in them, the others in their blocks; never one for itself as a whole
            assert all(surrogates.alphabet_of(surrogates.small(a)) == surrogates.alphabet_of(surrogates.small(b)) for a, b in zip(old, got, strict=True))
    assert s.replace("_@example.com") == ("_@example.com", [])
    names = ["O'Brien", "García-López", "Łuczak", "Иванов", "Νίκος", "山田", "דוד"]
    for name in names:
        new, kinds = s.replace(f"Mr. {name} came; {name} left")
        got = new.split()[1]
        assert kinds[0] == "person" and got != name and re.sub(r"[^\W\d_]+", "x", got) == re.sub(r"[^\W\d_]+", "x", name)
        assert name not in new or name in ("山田", "דוד")  # without capitals, later mentions cannot be told from words
    assert s.replace("Mr. O'Brien and O’Brien's")[0].replace("’", "'") == "Mr. {0} and {0}'s".format(s.name("", "", "O'Brien"))


def test_permutations_have_no_fixed_points():
    p = surrogates.Permuter(b"x")
    for n in (1, 2, 3):
        for letters in ("01", "0123456789"):
            every = ["".join(x) for x in itertools.product(letters, repeat=n)]
            new = [p.letters(x, letters, "t") for x in every]
            assert sorted(new) == every and all(a != b for a, b in zip(every, new, strict=True))
    for block in range(0x1100):
        for c, group in surrogates._block.__wrapped__(block).items():
            assert c in group and (len(group) > 1 or c == "\u2e2f")


def test_phones_by_country_code():
    s = surrogates.Surrogates(KEY)

    def digits(text):
        return re.sub(r"\D", "", text)

    for code, forms in {
        "49": ["+49 171 2345678", "+491712345678", "+49-171-2345-678", "+49 (171) 2345678"], "1": ["+1 (499) 555-6503", "+14995556503"],
        "353": ["+353 86 123 4567", "+353861234567"], "7": ["+7 912 345-67-89", "+79123456789"], "86": ["+86 138 0013 8000", "+8613800138000"],
    }.items():
        new = {digits(s.replace(f"call {form}!")[0]) for form in forms}
        assert len(new) == 1 and next(iter(new)).startswith(code) and new != {digits(forms[0])}, forms
    forms = ["0171 2345678", "0171/2345678", "(0171) 2345678", "0171-234-5678"]
    new = [s.replace(f"call {form}.") for form in forms]
    assert {tuple(kinds) for _, kinds in new} == {("phone",)} and len({digits(t) for t, _ in new}) == 1 and digits(new[0][0])[0] == "0"
    for form in ("06 12 34 56 78", "03-1234-5678", "020 7946 0958"):
        assert s.replace(form)[1] == ["phone"] and s.replace(form)[0] != form
    for text in ("01-02-2024", "on 05/06/2023 at 07:08", "0.12345678901", "2024-01-02 03-04-05", "012345678901234"):
        assert s.replace(text) == (text, [])


def test_addresses_of_both_kinds():
    s = surrogates.Surrogates(KEY)
    nets = {"10.1.2.3": "10.", "192.168.0.9": "192.168.", "127.0.0.1": "127.", "169.254.7.7": "169.254."}
    for text, net in nets.items():
        assert s.ip(text).startswith(net) and s.ip(text) != text
    some = [f"8.8.{a}.{b}" for a in range(4) for b in range(50)]
    new = {s.ip(x) for x in some}
    assert len(new) == len(some) and all(surrogates._host_bits([int(p) for p in x.split(".")]) == 32 for x in new) and not new & set(some)
    six = ["2001:db8::1", "2001:0db8:0000:0000:0000:0000:0000:0001", "2001:DB8::1"]
    got = [s.replace(f"at {x}, then") for x in six]
    assert {tuple(k) for _, k in got} == {("ip",)}
    assert got[0][0] == got[2][0].lower().replace("at ", "at ") and len(got[1][0]) == len(f"at {six[1]}, then")
    for text in ("12:30:45", "std::vector", "a::b", "bad::cafe::add", "::1"):
        assert s.replace(text) == (text, [])


def plain_known(texts, key, syllables):
    """Gender and attempt of every name, by loops over all texts."""
    votes = {}
    for text in texts:
        for _, _, _, gender, name in surrogates.persons(text or ""):
            name = surrogates.folded(name)
            votes[name] = votes.get(name, 0) + {"f": 1, "m": -1, "": 0}[gender]
    maker = surrogates.Surrogates(key, syllables=syllables)
    now = {name: ("f" if v > 0 else "m" if v < 0 else "", 0) for name, v in votes.items()}
    while True:
        by_new = {}
        for name, (gender, attempt) in now.items():
            by_new.setdefault(maker.candidate(name, gender, attempt), []).append((attempt, name))
        moved = {n for new, group in by_new.items() for _, n in (group if new in votes else []) + sorted(group)[1:]}
        if not moved:
            return now
        now = {n: (g, a + (n in moved)) for n, (g, a) in now.items()}


def test_against_plain_loops(spark):
    sf = "/root/testdata/sf0.01"
    texts = [r.text for r in table(spark, sf, "documents").orderBy("doc_id").collect()]
    parts = ["".join(x).capitalize() for x in itertools.product("bcd", "aei", "xyzv")]
    titles = [t for group in surrogates.TITLES.values() for t in group]
    named = [
        f"{t} {titles[i % len(titles)]} {parts[i % 36]} {parts[(i * 7) % 31]} wrote to {parts[i % 36]}. {titles[(i * 5) % len(titles)]} {parts[(i * 3) % 36]}"
        for i, t in enumerate(texts[:300])
    ]
    rows = list(enumerate([*named, *texts[300:], None, "", named[0], named[0]]))
    docs = spark.createDataFrame(rows, "_new_h long, text string").repartition(5)
    for syllables in (1, 4):
        maker = surrogates.Surrogates(KEY, plain_known([t for _, t in rows], KEY, syllables), syllables)
        want = {i: (None, 0) if t is None else (maker.replace(t)[0], maker.replace(t)[1].count("person")) for i, t in rows}
        for most in (100_000, 0):  # broadcast, joined
            got = surrogates.with_surrogates(docs, KEY, syllables=syllables, most_known=most).collect()
            assert {r._new_h: (r.text, r.n_person) for r in got} == want
            assert len(got) == len(rows)


def test_names_joined_for_a_hot_text_and_an_empty_table(spark):
    rows = [(1, "Mr. Sasha Ott and Mrs. Sasha Ott")] * 500 + [(2, "Herr Sasha Ott"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    a = surrogates.with_surrogates(docs, KEY).collect()
    b = surrogates.with_surrogates(docs, KEY, most_known=0).collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == 502
    assert surrogates.with_surrogates(docs.limit(0), KEY, most_known=0).collect() == []
