from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from cases import awkward, frame, prose, rows_of
from pyspark.sql import functions as F

from spark_refresh.llm import decontamination, extraction, surrogates, toxicity


# -- pages

ARTICLE = "A long paragraph with commas, clauses, and enough words to be taken for prose."


@pytest.mark.parametrize(("html", "want"), [
    (None, ""), ("", ""), ("<script>var a = '<p>x</p>';", ""), ("<!-- open", ""), ("bare words", "bare words"),
    (f"<body><nav><a href=x>Menu</a></nav><article><h1>T &amp; U</h1><p>{ARTICLE}<p>Two&nbsp;\n words<br>more</article><footer>f</footer>",
     f"T & U\n\n{ARTICLE}\n\nTwo words more"),
    (f"<div id=cookie-notice>We use cookies, many, many cookies, and ask you.</div><div class=story><p>{ARTICLE}</p><ul><li>one<li>two</ul>"
     f"<div class=ad>Buy, buy, buy.</div></div><div class=comments><p>{ARTICLE} said a reader</p></div><form><p>{ARTICLE}</form>",
     f"{ARTICLE}\n\none\n\ntwo"),
    ("<div>" * 3000 + ARTICLE, ARTICLE),
])
def test_main_text(html, want):
    assert extraction.main_text(html) == want


LONG = "".join(f"<p>{ARTICLE} Number {i}.</p>" for i in range(10))
TEN = [f"{ARTICLE} Number {i}." for i in range(10)]


@pytest.mark.parametrize(("html", "want"), [
    # uneven sections of one article
    (f"<nav><a href=/>Home</a></nav><div id=content><section>{LONG}</section><section><h2>After</h2><p>{ARTICLE}</p></section></div>", [*TEN, "After", ARTICLE]),
    (f"<div class=wrap><div><div>{LONG}</div></div><div><h3>Two</h3><div><p>{ARTICLE}</p></div></div></div><div class=footer>f</div>", [*TEN, "Two", ARTICLE]),
    # an article in pieces without semantic tags, links around it
    (f"<div><ul><li><a href=a>First story of the day</a><li><a href=b>Second story of the day, with more</a></ul></div>"
     f"<div id=x><div>{LONG}</div><div><p>{ARTICLE}</p></div><div><p>{ARTICLE}</p></div></div>", [*TEN, ARTICLE, ARTICLE]),
    # names that mean something else here
    (f"<article>{LONG}<div class=social-history><p>{ARTICLE}</p></div><div class=related><a href=a>More of this</a> <a href=b>And that</a></div></article>", [*TEN, ARTICLE]),
    (f"<div class=tags>{LONG}</div>", TEN), (f"<div class='legal search-results'>{LONG}</div>", TEN),
    (f"<article>{LONG}<div class=tags><a href=a>one</a>, <a href=b>two</a></div><div class=cookie-notice><p>{ARTICLE}</p></div></article>", TEN),
    (f"<body><div class=sidebar><p>{ARTICLE}</p></div><main>{LONG * 30}</main></body>", TEN * 30),
])
def test_articles_are_kept_whole(html, want):
    assert extraction.main_text(html).split("\n\n") == want


def test_pages_keep_their_rows(spark):
    df = spark.createDataFrame([(1, "u", f"<p>{ARTICLE}", 1), (1, "u", f"<p>{ARTICLE}", 1), (None, None, None, 2)], "page_id bigint, url string, html string, text int")
    got = rows_of(extraction.extract(df))
    assert sorted((r["page_id"] or 0, r["n_chars"], r["text"]) for r in got) == [(0, 0, "")] + [(1, len(ARTICLE), ARTICLE)] * 2
    assert rows_of(extraction.extract(df.where("false"))) == []


# -- benchmark items

ITEMS = [
    (1, "A train leaves Lyon with 12 wagons, and 12 wagons carry Anna and 340 kg of coal each before noon on that day"),
    (2, "The quick river runs under the old stone bridge while seven birds sleep in the tall reeds"), (3, None), (4, ""), (None, "no id here at all"),
]
OTHER = "A train leaves Nice with 15 wagons, and 15 wagons carry Olga and 270 kg of coal each before noon on that day"
MIXED = "A train leaves Nice with 15 wagons, and 19 wagons carry Olga and 270 kg of coal each before noon on that day"


def test_items_are_found_with_other_values_where_they_agree(spark):
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id bigint, text string, doc_id int")
    rows = awkward() + [
        (100, f"{prose(1, 50)}. {ITEMS[0][1]} {prose(2, 50)}"), (101, f"{prose(3, 50)}. {OTHER}"), (102, f"{prose(5, 50)}. {MIXED}"),
        (103, f"{ITEMS[1][1].upper()}"), (104, ITEMS[1][1][:40]), (105, f"{OTHER}. {ITEMS[0][1]}")]
    got = {(r["doc_id"], r["item_id"]) for r in rows_of(decontamination.contaminated(frame(spark, rows), items))}
    assert got == {(100, 1), (101, 1), (103, 2), (105, 1)}
    assert rows_of(decontamination.contaminated(frame(spark, []), items)) == []
    assert rows_of(decontamination.contaminated(frame(spark, rows), items.where("false"))) == []


def test_items_are_found_as_they_are_whatever_stands_before(spark):
    texts = {1: "What is 12 + 30?", 2: "What is the capital of France?", 3: "Who wrote the novel Dracula?", 4: "Name three noble gases",
             5: "12 + 30 + 41 + 7 - 19", 6: "Who wrote the long novel Dracula before 1900 came to London?"}
    items = spark.createDataFrame(list(texts.items()), "item_id bigint, text string")
    rows = awkward() + [(100 + i, f"{prose(i, 20)}. Question: {t} {prose(40 + i, 20)}") for i, t in texts.items()]
    rows += [(200, "Question: Who wrote the long novel Emma before 1816 came to Bath?"), (201, "What is 13 + 30?"), (202, "What is the capital of Norway?")]
    got = {(r["doc_id"], r["item_id"]) for r in rows_of(decontamination.contaminated(frame(spark, rows), items))}
    assert got >= {(100 + i, i) for i in texts} | {(200, 6)}
    assert not got & {(201, 1), (201, 5), *((101, i) for i in (2, 3, 4, 5, 6))}


def cut_by_hand(text: str) -> list[str]:
    """Tokens of a text, one pattern after the other."""
    named = regex.sub(decontamination.NAME, lambda m: "\x01" + m[0], text)
    numbered = regex.sub(decontamination.NUMBER, lambda m: "\x02" + m[0] + " ", named)
    units = regex.sub(rf"(?i)({decontamination.VALUE} {{1,2}}-?)({decontamination.UNITS})(?![\p{{L}}])", lambda m: m[1] + "\x03" + m[2], numbered)
    return [m[0] for m in regex.finditer(decontamination.TOKEN, units.lower())]


def held_by_hand(doc: list[str], item: list[str]) -> bool:
    """Whether a document holds an item, window by window, with values that agree or as it is."""
    n = min(5, len(item))

    def windows(tokens, form):
        return [(i, tuple(map(form, tokens[i : i + n]))) for i in range(len(tokens) - n + 1)]

    def plain(t):
        return t[1:] if t < "\x04" else t

    def kind(t):
        return t[0] if t < "\x04" else t

    same = {w for _, w in windows(item, plain)}
    if len(same & {w for _, w in windows(doc, plain)}) / len(same) >= 0.8:
        return True
    wanted = [(i, w) for i, w in windows(item, kind) if sum(t >= "\x04" for t in w) >= min(3, len(w))]
    there = defaultdict(list)
    for i, w in windows(doc, kind):
        there[w].append(i)
    distinct = {w for _, w in wanted}
    if not distinct or sum(w in there for w in distinct) / len(distinct) < 0.8:
        return False
    means, times, inside = defaultdict(set), Counter(), Counter(w for _, w in wanted)
    for i, w in wanted:
        for k, t in enumerate(item[i : i + n]):
            if t < "\x04" and w in there:
                means[t] |= {doc[j + k] for j in there[w]}
                times[t] = max(times[t], -(-len(there[w]) // inside[w]))
    return not means or sum(len(m) <= times[t] for t, m in means.items()) / len(means) >= 0.9


def test_items_are_found_like_by_hand(spark):
    r = random.Random(17)
    numbers = ["12", "7", "3.5", "sixty", "twelve", "two hundred and five"]
    names = ["Anna", "Olga", "Ivan", "Rosa"]
    shapes = ["A car drives {a} km in {b} hours and {n} walks {a} km more how long does the way of {n} take in all",
              "If {n} buys {a} books and {m} buys {b} pens for {a} dollars each what does {m} pay for the {b} pens", "What is {a} plus {b}"]

    def filled(shape: str, **more) -> str:
        values = {"a": r.choice(numbers), "b": r.choice(numbers), "n": r.choice(names), "m": r.choice(names)}
        return shape.format(**(values | more))

    items = {i: filled(shapes[i % 3]) for i in range(9)}
    rows = [(1, prose(1, 90)), (2, ""), (3, None)]
    for i in range(150):
        text = filled(r.choice(shapes)) if r.random() < 0.8 else r.choice(list(items.values()))
        words = text.split()
        for _ in range(r.choice([0, 0, 1, 4])):
            words[r.randrange(len(words))] = r.choice([*numbers[:5], "and", "road"])
        rows.append((100 + i, f"{prose(i, 12)}. {' '.join(words)} {prose(500 + i, 8)}"))
    table = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    got = {(x["doc_id"], x["item_id"]) for x in rows_of(decontamination.contaminated(frame(spark, rows), table))}
    want = {
        (d, i) for d, t in rows for i, item in items.items()
        if t and any(held_by_hand(cut_by_hand(t), cut_by_hand(form)) for form in (item, ": " + item))}
    assert got == want and 30 < len(want) < 1000


def test_spelled_numbers_are_numbers(spark):
    items = spark.createDataFrame([(1, "A cyclist rides sixty km in three hours and then rests, how far does she ride in twelve hours at this speed")], "item_id bigint, text string")
    rows = [(1, "A cyclist rides 45 km in 2 hours and then rests, how far does she ride in 9 hours at this speed"),
            (2, "a cyclist rides sixty-five km in two hours and then rests, how far does she ride in one hundred and ten hours at this speed"),
            (3, "A cyclist rides home and then rests, how far does she ride on most days at this speed")]
    assert {r["doc_id"] for r in rows_of(decontamination.contaminated(frame(spark, rows), items))} == {1, 2}


# -- surrogates

CARD, OTHER_CARD, NO_CARD = "4539578763621486", "4485275742308327", "4539578763621487"


def test_surrogates_keep_form_and_identity(spark):
    texts = {
        200: f"Write to ann.lee@mail.example.com or call +1 (217) 555-7713. Card {CARD}, host 97.51.17.173.",
        201: f'ANN.LEE@MAIL.EXAMPLE.COM paid with {CARD[:4]} {CARD[4:8]} {CARD[8:12]} {CARD[12:]}; token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"',
        202: f"Mr. Ivan Petrov met Ms. Rosa Diaz; Mr. Иван Петров too. No card: {NO_CARD}, version 4.0, 12345.",
        203: f"Card {OTHER_CARD} and Dr. Rosa Diaz.",
    }
    got = {}
    for r in rows_of(surrogates.replace(frame(spark, awkward() + list(texts.items())), "k")):
        got.setdefault(r["doc_id"], r)
    for doc, text in awkward():
        if doc in (1, 2, 3, 6, 8, 9, 12):
            assert got[doc]["text"] == text and got[doc]["n_entities"] == 0
    first = re.fullmatch(r"Write to ([a-z]+\.[a-z]+@[a-z]+\.[a-z]+\.com) or call (\+1 \(\d{3}\) \d{3}-\d{4})\. Card (\d{16}), host ([\d.]+)\.", got[200]["text"])
    assert first and first[1] != "ann.lee@mail.example.com" and first[3] != CARD
    assert got[200]["n_entities"] == 4 and all(0 <= int(p) <= 255 for p in first[4].split("."))
    second = re.fullmatch(r'(\S+) paid with (\d{4} \d{4} \d{4} \d{4}); token = "([0-9a-f]{40})"', got[201]["text"])
    assert second and second[1] == first[1].upper() and second[2].replace(" ", "") == first[3]
    assert surrogates_luhn(first[3])
    third = re.fullmatch(rf"Mr\. (\w+ \w+) met Ms\. (\w+ \w+); Mr\. ([А-Яа-я]+ [А-Яа-я]+) too\. No card: {NO_CARD}, version 4\.0, 12345\.", got[202]["text"])
    assert third and third[2] != "Rosa Diaz"
    assert f"Dr. {third[2]}." in got[203]["text"]
    again = {r["doc_id"]: r["text"] for r in rows_of(surrogates.replace(frame(spark, list(texts.items())), "k"))}
    assert all(again[d] == got[d]["text"] for d in texts)
    assert rows_of(surrogates.replace(frame(spark, []), "k")) == []


def test_nothing_personal_is_left(spark):
    texts = {
        1: '{"password": "hunter2hunter2"} and password=hunter3hunter3 or token: abcdef123456789',
        2: "Amex 378282246310005, grouped 3782 822463 10005; other 4222222222222; no card 378282246310006.",
        3: "My name is Alice Johnson. Dr. Alice Johnson wrote. Alice Johnson left, Alice Johnsonville stays.",
        4: "Host 2001:0db8:85a3:0000:0000:8a2e:0370:7334 or fe80::1ff:fe23:4567:890a at 10:30:45.",
        5: "The secret: nothing at all, a key to everything; password is what you know. He said: 'tomorrow morning'.",
    }
    got = {r["doc_id"]: (r["text"], r["n_entities"]) for r in rows_of(surrogates.replace(frame(spark, list(texts.items())), "k"))}
    for gone in ("hunter2", "hunter3", "abcdef123456789"):
        assert gone not in got[1][0]
    assert got[1][1] == 3 and got[1][0].startswith('{"password": "') and len(got[1][0]) == len(texts[1])
    assert re.fullmatch(r"Amex \d{15}, grouped \d{4} \d{6} \d{5}; other \d{13}; no card 378282246310006\.", got[2][0])
    one, two, three = re.findall(r"\d[\d ]+\d", got[2][0])[:3]
    assert one == two.replace(" ", "") != "378282246310005" and surrogates_luhn(one) and surrogates_luhn(three)
    name = re.fullmatch(r"My name is (\w+ \w+)\. Dr\. (\w+ \w+) wrote\. (\w+ \w+) left, Alice Johnsonville stays\.", got[3][0])
    assert name and name[1] == name[2] == name[3] != "Alice Johnson" and got[3][1] == 3
    assert re.fullmatch(r"Host (?:[0-9a-f]{4}:){7}[0-9a-f]{4} or [0-9a-f]{4}::[0-9a-f]{3}:[0-9a-f]{4}:[0-9a-f]{4}:[0-9a-f]{4} at 10:30:45\.", got[4][0]) and got[4][1] == 2
    assert got[5] == (texts[5], 0)
    other = {r["doc_id"]: r["text"] for r in rows_of(surrogates.replace(frame(spark, list(texts.items())), "another key"))}
    assert all(other[d] != got[d][0] for d in (1, 2, 3, 4))


def test_crowded_forms_grow(spark):
    """As many addresses as their form has surrogates, each of them an entity."""
    entities = spark.range(676).selectExpr("concat(char(97 + id % 26), '@', char(97 + id div 26), '.co') AS entity").selectExpr("entity", "'email' AS kind", "'email' AS sort").distinct()
    given = rows_of(surrogates.assigned(entities, "k"))
    assert len(given) == entities.count() == len({r["surrogate"] for r in given})
    assert not {r["surrogate"] for r in given} & {r["entity"] for r in given}
    assert all(re.fullmatch(r"[a-p]*[a-z]@[a-z]\.co", r["surrogate"]) for r in given)


def surrogates_luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def test_surrogates_of_a_crowded_form_stay_distinct(spark):
    df = spark.createDataFrame([(i, f"0{i // 10}.{i % 10}.0.1 x {i}.1.1.1") for i in range(100)], "doc_id bigint, text string")
    entities = spark.createDataFrame([(f"{i:03d}-{i % 7:02d}-0001", "ssn", "ssn") for i in range(300)], "entity string, kind string, sort string")
    given = rows_of(surrogates.assigned(entities, "k"))
    assert len({r["surrogate"] for r in given}) == len({r["entity"] for r in given}) == 300
    assert not {r["surrogate"] for r in given} & {r["entity"] for r in given}
    assert surrogates.replace(df, "k").count() == 100


# -- toxicity


def held_out(doc) -> bool:
    return zlib.crc32(str(doc).encode()) % 4 == 2


def test_toxic_expressions_are_learned(spark):
    r = random.Random(8)
    rows, labels = [], []
    for doc in range(600):
        toxic = doc % 4 == 0
        words = prose(20_000 + doc, r.randint(40, 200)).split()
        for _ in range(max(2, len(words) // 25) if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(["zyxxer", "qwarg", "zyxxest", "qwargly"]))
        rows.append((1000 + doc, " ".join(words)))
        labels.append((1000 + doc, 1, int(toxic)))
    labels += [(None, 1, 1), (1000, 1, None)]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = rows_of(toxicity.score(frame(spark, rows + awkward()), table))
    assert len(got) == len(rows) + len(awkward())
    wrong = sum(r["predicted"] != int((r["doc_id"] - 1000) % 4 == 0) for r in got if (r["doc_id"] or 0) >= 1000 and r["held_out"])
    assert wrong <= 0.05 * sum(held_out(d) for d, _ in rows)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["doc_id"] is None or r["held_out"] == held_out(r["doc_id"])
    nothing = rows_of(toxicity.score(frame(spark, awkward()), table.where("false")))
    assert {r["predicted"] for r in nothing} == {0}
    assert rows_of(toxicity.score(frame(spark, []), table)) == []


def whole_model(texts: dict[int, str], labels: dict[int, int]) -> dict[int, float]:
    """Scores with every sequence kept in memory."""
    def cut(word: str) -> list[str]:
        padded = " " * (toxicity.ORDER - 1) + word + " "
        return [padded[i : i + toxicity.ORDER] for i in range(len(word) + 1)]

    words = {d: [cut(w) for w in re.findall(r"[^\W_]+", t.lower())] for d, t in texts.items()}
    level = Counter(k for some in words.values() for w in some for k in w)
    levels = [level]
    for _ in range(toxicity.ORDER - 1):
        lower = Counter()
        for k, n in level.items():
            lower[k[1:]] += n if k[1] == " " else 1
        levels.append(level := lower)
    total = sum(level.values())
    below = {k: n / total for k, n in level.items()}
    for level in levels[-2::-1]:
        totals, kinds = Counter(), Counter()
        for k, n in level.items():
            totals[k[:-1]] += n
            kinds[k[:-1]] += 1
        below = {k: ((n - toxicity.DISCOUNT) + toxicity.DISCOUNT * kinds[k[:-1]] * below[k[1:]]) / totals[k[:-1]] for k, n in level.items()}

    def measured(learn: set[int]):
        counts, totals, kinds = (defaultdict(Counter) for _ in range(3))
        for d in learn:
            counts[labels[d]].update(k for w in words[d] for k in w)
        for c in (0, 1):
            for k, n in counts[c].items():
                totals[c][k[:-1]] += n
                kinds[c][k[:-1]] += 1

        def value(k):
            out = 0.0
            for c, sign in ((1, 1), (0, -1)):
                context = k[:-1]
                weight = (toxicity.DISCOUNT * kinds[c][context] + toxicity.SHARED) / (totals[c][context] + toxicity.SHARED)
                seen = counts[0][k] or counts[1][k]
                out += sign * math.log(max(counts[c][k] - toxicity.DISCOUNT, 0) / (totals[c][context] + toxicity.SHARED) + weight * below[k] if seen else weight)
            return out

        return {d: toxicity.measures(np.array([sum(map(value, w)) for w in some])) for d, some in words.items()}

    part = {d: zlib.crc32(str(d).encode()) % 4 for d in texts}
    first = measured({d for d in labels if part[d] not in (2, 3)})
    weights = toxicity.fit_logistic([(*first[d], labels[d]) for d in labels if part[d] == 3])
    whole = measured({d for d in labels if part[d] != 2})
    return {d: 1 / (1 + math.exp(-(weights[0] + weights[1] * a + weights[2] * b))) for d, (a, b) in whole.items()}


@pytest.mark.parametrize("most", [0, 10**6])
def test_every_sequence_takes_part_in_the_score(spark, most):
    """Against a model in memory; the sequences are many enough to meet in slots of a table of fixed size."""
    r = random.Random(31)
    texts, labels = {}, {}
    for doc in range(240):
        words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 9))) for _ in range(60)]
        toxic = int(doc % 3 == 0)
        texts[doc] = " ".join(words + ["zyxxer qwarg"] * (toxic * r.randint(0, 3)))
        labels[doc] = toxic
    texts |= {1000: "", 1001: " . ", 1002: "zyxxer", 1003: "ab " * 3000 + "zyxxer qwarg", 1004: "日本語 — テスト ЖЖЖ 🙂"}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    table = spark.createDataFrame(list(labels.items()), "doc_id bigint, toxic int")
    want = whole_model(texts, labels)
    got = {x["doc_id"]: x["score"] for x in rows_of(toxicity.score(df, table, most=most))}
    assert set(got) == set(want)
    assert max(abs(got[d] - want[d]) for d in want) < 1e-6


def test_windows_are_hashed_without_copies(spark):
    rows = [(i, list(range(n))) for i, n in enumerate((0, 1, 4, 5, 6, 40))]
    df = spark.createDataFrame(rows, "id int, parts array<long>").repartition(1)
    windows = F.expr("transform(sequence(1, size(parts) - 4), i -> xxhash64(slice(parts, i, 5)))")
    got = df.select("parts", decontamination.window_hashes(F.col("parts"), 5).alias("hashes"))
    assert "xxhash64(slice(" not in got._jdf.queryExecution().analyzed().toString()  # a slice copies all of the array
    for r in got.withColumn("wanted", F.when(F.size("parts") > 4, windows).otherwise(F.array().cast("array<bigint>"))).collect():
        assert r["hashes"] == r["wanted"]
