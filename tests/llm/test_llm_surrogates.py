import re

from cohortkit.llm import surrogates as S

SCHEMA = "doc_id long, text string, _x string"
MAIL = r"[^\s@]+@[^\s@]+\.(?:com|net|org)"


def run(spark, texts, key="k"):
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    docs, table = S.replace(spark.createDataFrame(rows, SCHEMA), key)
    return {r.doc_id: r for r in docs.collect()}, table.collect()


def luhn(s):
    d = [int(c) for c in re.sub(r"\D", "", s)][::-1]
    return sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])


def test_types_formats_and_coreference(spark):
    texts = [
        "Mail Bob.Lee@mail7.acme.org or BOB.LEE@MAIL7.ACME.ORG now.",
        "Card 4111 1111 1111 1111, again 4111111111111111; not Luhn 9807915762804490",
        "Call +1 (017) 555-7713 from 10.0.0.7 or 8.8.8.8, ssn 123-45-6789, v3.0.1",
        "Mrs Anna Smith met Mr John Smith; Mr. Smith left. Госпожа Анна Петрова.",
        'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"', "clean 3.0 text", "", None, "bob.lee@mail7.acme.org",
    ]
    out, table = run(spark, texts)
    a, b = re.findall(MAIL, out[0].text, re.I)
    assert a.lower() == b.lower() and b == b.upper() and a.lower() != "bob.lee@mail7.acme.org"
    assert a.lower() == out[8].text and re.fullmatch(r"[a-z]{3}\.[a-z]{3}@[a-z]{4}\d\.example\.org", out[8].text)
    first, second, third = re.findall(r"\d{4}(?: ?\d{4}){3}", out[1].text)
    assert first.count(" ") == 3 and first.replace(" ", "") == second
    assert luhn(second) % 10 == 0 and luhn(third) % 10 != 0
    assert re.fullmatch(r"Call \+1 \(\d{3}\) \d{3}-\d{4} from 10\.\d+\.\d+\.\d+ or \d+\.\d+\.\d+\.\d+, ssn 9\d\d-\d\d-\d{4}, v3\.0\.1", out[2].text)
    m = re.fullmatch(r"Mrs (\w+) (\w+) met Mr (\w+) (\w+); Mr\. (\w+) left\. Госпожа (\w+) (\w+)\.", out[3].text)
    assert m and m[2] == m[4] == m[5] and m[2] != "Smith" and m[1] != m[3]
    assert m[1].endswith(("na", "lia", "sa", "rine")) and re.fullmatch("[А-Яа-я]+", m[6])
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', out[4].text) and out[4].text != texts[4]
    assert [out[i].text for i in (5, 6, 7)] == texts[5:8]
    assert [out[i]["__ck_replaced"] for i in (0, 5, 7)] == [2, 0, 0]
    assert len({(r.type, r.surrogate) for r in table}) == len(table) == len({(r.type, r.canon) for r in table})
    again, _ = run(spark, texts)
    assert {k: r.text for k, r in again.items()} == {k: r.text for k, r in out.items()}
    assert run(spark, texts, "other")[0][0].text != out[0].text


def test_collisions_are_resolved(spark):
    # 26 one-letter surrogates for many one-letter mailboxes of many hosts
    mails = [f"{c}@h{i}.com" for c in "abcdefgh" for i in range(40)]
    out, table = run(spark, [" ".join(mails[i::10]) for i in range(10)])
    entity = {r.canon: r.surrogate for r in table}
    assert set(entity) == set(mails) and len(set(entity.values())) == len(mails)
    assert not set(entity.values()) & set(mails)
    assert max(r.draw for r in table) > 0
    for i in range(10):
        assert out[i].text == " ".join(entity[m] for m in mails[i::10])


def test_a_used_up_address_range_is_widened(spark):
    rows = [("ipv4", f"192.168.{a}.{b}") for a in range(1, 251) for b in range(1, 161)]
    table = S.assign(spark.createDataFrame(rows, "type string, canon string"), "k").collect()
    found = {r.canon: r.surrogate for r in table}
    assert len(table) == len(found) == len(set(found.values())) == 40_000
    assert not set(found.values()) & set(found)
    parts = [[int(x) for x in s.split(".")] for s in found.values()]
    assert all(len(p) == 4 and all(0 <= x <= 255 for x in p) and (p[0] == 10 or p[:2] == [192, 168]) for p in parts)
    assert {p[0] for p in parts} == {10, 192}


def test_a_type_without_surrogates_left_gets_tags(spark):
    # phone surrogates keep the first digit: ten numbers of two digits, all of them real
    rows = [("phone", f"5{i}") for i in range(10)]
    table = S.assign(spark.createDataFrame(rows, "type string, canon string"), "k", max_draws=2).collect()
    assert len({r.surrogate for r in table}) == 10 and all(r.surrogate.startswith("[phone-") for r in table)


def test_repeated_and_null_ids_and_empty(spark):
    rows = [(None, "a.b@c.com", "x"), (None, "a.b@c.com and d.e@c.com", "x"), (1, "a.b@c.com", "y"), (1, "a.b@c.com", "y"), (None, None, "z")]
    docs, _ = S.replace(spark.createDataFrame(rows, SCHEMA))
    got = docs.collect()
    one = {r.text for r in got if r.text and " and " not in r.text}
    assert len(got) == 5 and len(one) == 1
    assert [r.text.startswith(one.copy().pop()) for r in got if r.text and " and " in r.text] == [True]
    assert docs.columns == ["doc_id", "text", "_x", "__ck_replaced"]
    assert S.replace(spark.createDataFrame([], SCHEMA))[0].count() == 0
