from __future__ import annotations

import hashlib
import random
import re
from datetime import date

from pyspark.sql import functions as F

from citeweave.llm.chat_pairs import neighbour_pairs, preference_examples, preference_turns
from citeweave.llm.pii import permuted, pseudonymised

from .cases import no_docs, odd_docs, rows


def luhn_ok(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_values_are_replaced_within_their_format(spark):
    texts = ["a jo.ann.7@mail.example.com, b", "call +1 (555) 010-4477 now", "at 10.20.30.255.", "born 1987-02-28, or 28.02.1987",
             "us 02/28/1987", "card 4111111111111111 and 4111 1111 1111 1111", "ssn 078-05-1120",
             "iban GB82 WEST 1234 5698 7654 32 end"]
    found = [r for r in pseudonymised(frame(spark, texts), "k").orderBy("doc_id").collect()]
    kinds = [[p.kind for p in r._pii] for r in found]
    assert kinds == [["email"], ["phone"], ["ip"], ["date", "date"], ["date"], ["card", "card"], ["ssn"], ["iban"]]
    for text, row in zip(texts, found, strict=True):
        assert row.text != text
        assert re.sub("[0-9]", "9", re.sub("[a-z]", "a", row.text))[:3] == re.sub("[0-9]", "9", re.sub("[a-z]", "a", text))[:3]
    assert "@mail.example.com, b" in found[0].text and found[1].text.startswith("call +1 (")
    assert all(int(part) <= 255 for part in re.findall(r"\d+", found[2].text))
    one, two = re.findall(r"\d{4}-\d{2}-\d{2}", found[3].text)[0], re.findall(r"\d{2}\.\d{2}\.\d{4}", found[3].text)[0]
    assert date.fromisoformat(one) == date(int(two[6:]), int(two[3:5]), int(two[:2]))  # equal dates stay linked
    cards = [re.sub(r"\D", "", p.pseudonym) for p in found[5]._pii]
    assert cards[0] != "4111111111111111" and all(luhn_ok(c) and c[0] == "4" for c in cards)
    account = found[7]._pii[0].pseudonym.replace(" ", "")
    turned = account[4:] + account[:4]
    assert int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def test_what_is_not_valid_is_left_alone(spark):
    texts = ["4111111111111112", "300.1.2.3", "1987-02-30", "000-12-3456", "version 3.0.1, page 12345", "x4111111111111111",
             "", None, "plain words only", "a@b", "GB00 WEST 1234 5698 7654 32"]
    found = pseudonymised(frame(spark, texts), "k").orderBy("doc_id").collect()
    assert [r.text for r in found] == texts and not any(r._pii for r in found)


def test_equal_values_are_linked_and_keys_differ(spark):
    docs = frame(spark, ["see 1.2.3.4", "1.2.3.4 again", "1.2.3.5"])
    one = [r._pii[0].pseudonym for r in pseudonymised(docs, "k").orderBy("doc_id").collect()]
    two = [r._pii[0].pseudonym for r in pseudonymised(docs, "other").orderBy("doc_id").collect()]
    assert one[0] == one[1] != one[2] and one[0] != two[0]


def test_the_network_is_a_permutation(spark):
    pairs = [(a, b) for a in range(7) for b in range(11)]
    values = spark.createDataFrame(pairs, "a int, b int").select(permuted(F.array(
        F.struct(F.col("a").alias("value"), F.lit(7).alias("size")),
        F.struct(F.col("b").alias("value"), F.lit(11).alias("size"))), "key", F.lit("t")).alias("new"))
    new = {tuple(r.new) for r in values.collect()}
    assert new == set(pairs) and [tuple(r.new) for r in values.collect()] != pairs


def feistel(values, sizes, key, tweak):
    """The network anew: halves swap places eight times."""
    places = list(zip(values, sizes, strict=True))
    left, right = places[:len(places) // 2], places[len(places) // 2:]
    for number in range(1, 9):
        other = ",".join(str(v) for v, _ in right)
        hashes = [hashlib.sha256(f"{key}|{tweak}|{number}|{i}|{other}".encode()).hexdigest() for i in range(len(left))]
        left, right = right, [((v + int(h[:12], 16)) % n, n) for (v, n), h in zip(left, hashes, strict=True)]
    return [v for v, _ in left + right]


def test_numbers_against_brute_force_in_every_spelling(spark):
    def digits(text, tweak):
        return "".join(map(str, feistel([int(c) for c in text], [10] * len(text), "k", tweak)))

    card = "4" + digits("11111111111111", "card")
    card = next(card + c for c in "0123456789" if luhn_ok(card + c))
    phone = digits("5550104477", "phone")
    account = list("WEST12345698765432")
    sizes = [10 if c.isdigit() else 26 for c in account]
    new = feistel([int(c) if c.isdigit() else ord(c) - 65 for c in account], sizes, "k", "iban")
    body = "".join(str(v) if n == 10 else chr(65 + v) for v, n in zip(new, sizes, strict=True))
    iban = next(f"GB{c:02}{body}" for c in range(2, 99)
                if int("".join(str(int(x, 36)) for x in f"{body}GB{c:02}")) % 97 == 1)
    cases = {"4111111111111111": card, "4111 1111 1111 1111": card, "4111-1111-1111-1111": card,
             "555-010-4477": phone, "(555) 010-4477": phone, "+1 (555) 010-4477": "1" + phone, "+15550104477": "1" + phone,
             "GB82 WEST 1234 5698 7654 32": iban, "GB82WEST12345698765432": iban}
    found = pseudonymised(frame(spark, [f"a {text}, b" for text in cases]), "k").orderBy("doc_id").collect()
    for (text, expected), row in zip(cases.items(), found, strict=True):
        pseudonym = row._pii[0].pseudonym
        assert re.sub(r"[^A-Z0-9]", "", pseudonym) == expected and row.text == f"a {pseudonym}, b"
        assert re.sub(r"[A-Z0-9]", "", pseudonym) == re.sub(r"[A-Z0-9]", "", text)  # separators stay


def test_dates_of_all_years_against_brute_force(spark):
    start, cycle = date(1800, 1, 1).toordinal(), 146_097
    others = [day.toordinal() + 365 for day in (date(1, 1, 1), date(1799, 12, 31))] + [
        day.toordinal() + 365 - cycle for day in (date(2200, 1, 1), date(9999, 12, 31))]
    texts = ["0001-01-01", "31.12.1799", "01/01/2200", "9999-12-31", "1800-01-01", "2199-12-31", "0000-02-29"]
    found = [r._pii[0] for r in pseudonymised(frame(spark, texts), "k").orderBy("doc_id").collect()]
    for text, pii, day in zip(texts, found, others, strict=False):
        a, b = feistel([day // 773, day % 773], [4536, 773], "k", "date")
        new = a * 773 + b
        new += cycle if new >= start + 365 else 0
        if new >= 366:
            form = "%d.%m.%Y" if "." in text else "%m/%d/%Y" if "/" in text else "%Y-%m-%d"
            year = date.fromordinal(new - 365).year
            assert pii.pseudonym == date.fromordinal(new - 365).strftime(form.replace("%Y", f"{year:04}"))
        assert not 1800 <= int(re.search(r"\d{4}", pii.pseudonym)[0]) <= 2199
    for text, pii in zip(texts[4:6], found[4:6], strict=True):
        day = date.fromisoformat(text).toordinal() - start
        a, b = feistel([day // 773, day % 773], [189, 773], "k", "date")
        assert date.fromisoformat(pii.pseudonym).toordinal() - start == a * 773 + b
    assert found[6].kind == "date" and len({pii.pseudonym for pii in found}) == 7


def test_odd_documents_keep_rows_and_columns(spark):
    found = pseudonymised(odd_docs(spark), "k")
    assert found.columns == [*odd_docs(spark).columns, "_pii"]
    before = {(r[0], r[1]) for r in rows()}
    changed = [r for r in found.collect() if (r.doc_id, r.text) not in before]
    assert [r.doc_id for r in changed] == [19] and len(changed[0]._pii) == 3
    assert found.count() == len(rows()) and pseudonymised(no_docs(spark), "k").count() == 0


TURNS = "conv_id bigint, turn bigint, role string, text string, part string, place string"


def turns(spark, data):
    return spark.createDataFrame([(*row, "x", "y") for row in data], TURNS)


def test_common_prefix_and_masks(spark):
    data = [(0, 0, "user", "hi"), (0, 1, "assistant", "hello"), (0, 2, "user", "bye"), (0, 3, "assistant", "ok"),
            (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "why"),
            (2, 0, "user", "a"), (3, 0, "user", "a"),  # equal: all prompt
            (4, 0, "user", "a"), (5, 0, "user", "b"), (6, 0, "user", "alone"), (None, 0, "user", "none"),
            (8, None, None, None), (9, 5, "assistant", "é"), (9, 5, "assistant", "é")]
    frame_ = turns(spark, data)
    segments = preference_turns(frame_, neighbour_pairs(frame_))
    rows_ = segments.collect()
    got = sorted((r.pair_id, r.part, -1 if r.turn is None else r.turn, r.role) for r in rows_)
    assert got == sorted([
        (0, "prompt", 0, "user"), (0, "prompt", 1, "assistant"), (0, "chosen", 2, "user"), (0, "chosen", 3, "assistant"),
        (0, "rejected", 2, "user"), (1, "prompt", 0, "user"), (2, "chosen", 0, "user"), (2, "rejected", 0, "user"),
        (4, "chosen", -1, ""), (4, "rejected", 5, "assistant"), (4, "rejected", 5, "assistant")])
    for r in rows_:
        learned = r.rendered[r.learn_from:r.learn_to]
        assert learned == ("" if r.part == "prompt" or r.role != "assistant" else {"ok": "ok<|im_end|>"}.get(
            "ok", "") if r.pair_id == 0 else "é<|im_end|>")
    example = {r.pair_id: r for r in preference_examples(segments).collect()}[0]
    assert example.prompt == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n"
    assert example.rejected == "<|im_start|>user\nwhy<|im_end|>\n"


def test_prefixes_against_brute_force(spark):
    rng = random.Random(12)
    data = [(conv, turn, rng.choice(["user", "assistant"]), rng.choice("ab")) for conv in range(120)
            for turn in range(rng.randint(1, 7))]
    frame_ = turns(spark, data)
    found = preference_turns(frame_, neighbour_pairs(frame_)).where("part = 'prompt'").groupBy("pair_id").count()
    lengths = {r.pair_id: r["count"] for r in found.collect()}
    for pair in range(60):
        one, two = ([row[1:] for row in data if row[0] == conv] for conv in (2 * pair, 2 * pair + 1))
        same = 0
        while same < min(len(one), len(two)) and one[same] == two[same]:
            same += 1
        assert lengths.get(pair, 0) == same
    empty = turns(spark, [])
    assert preference_turns(empty, neighbour_pairs(empty)).count() == 0


def test_pairs_of_large_and_negative_ids(spark):
    ids = [(1 << 60) + i for i in range(4)] + [-4, -3, -1, 0, 7, (1 << 63) - 2, (1 << 63) - 1]
    turns = spark.createDataFrame([(i,) for i in ids] * 2 + [(None,)], "conv_id bigint")
    found = {(r.chosen_id, r.rejected_id): r.pair_id for r in neighbour_pairs(turns).collect()}
    assert found == {(a, a + 1): a // 2 for a in (1 << 60, (1 << 60) + 2, -4, (1 << 63) - 2)}
