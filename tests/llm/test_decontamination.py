"""Re-parameterised, edited and verbatim copies of benchmark items, planted into other text."""

import os
import random
import re

import pytest

from eventloom.llm import decontamination as D

DIR = "/root/testdata/sf0.001"
QUESTIONS = [
    "Tom has 5 apples. Anna buys 2 apples from him on Monday. Tom eats 3 pears later. How many apples does Tom have left?",
    "A train leaves Paris at 9 and travels 240 km to Lyon. Another train leaves Lyon an hour later. Where do the trains from Paris and Lyon meet?",
    "Mary Ann pays 12 dollars for 4 tickets. Her friend Bob pays for 6 tickets at the same price. How much does Bob pay?",
    "In 1987 the town of Ulm sold 300 trees. In 1988 Ulm sold half as many trees as before. How many trees did the town sell in all?",
]
NAMES = ["Lucy", "Mary", "Peter", "Carl Otto", "Jo Ann Smith", "Vera", "Ivo", "Zoe Lee"]


def swapped(text: str, rng: random.Random) -> str:
    """The question with other names, of one to three words, and other numbers, the same for the same."""
    found = dict.fromkeys(re.findall(r"\b(?:Tom|Anna|Monday|Paris|Lyon|Mary Ann|Bob|Ulm|\d+)\b", text))
    names = rng.sample(NAMES, len(NAMES))
    numbers = iter(rng.sample(range(1000, 9000), len(found)))
    to = {x: str(next(numbers)) if x.isdigit() else names.pop() for x in found}
    return re.sub("|".join(sorted(map(re.escape, to), key=len, reverse=True)), lambda m: to[m[0]], text)


def broken(text: str, rng: random.Random) -> str:
    """Other names and numbers, but each place has a value of its own."""
    values = iter(range(1000, 9000))
    return re.sub(r"\b(?:Tom|Anna|Monday|Paris|Lyon|Mary Ann|Bob|Ulm|\d+)\b", lambda m: str(next(values)) if m[0].isdigit() else rng.choice(NAMES) + "son" + chr(97 + next(values) % 26), text)


def found(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.item_id) for r in D.contaminated(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}


def test_names_at_sentence_starts_and_of_several_words(spark):
    items = [QUESTIONS[0]]
    texts = [
        "Lucy has 7 apples. Mary buys 4 apples from her on Friday. Lucy eats 6 pears later. How many apples does Lucy have left?".replace("from her", "from him"),
        QUESTIONS[0].replace("Anna", "Mary Ann").replace("5", "8"),
        "So. " + QUESTIONS[0].replace("Tom", "Jo Ann Smith") + " And so on.",
    ]
    assert found(spark, texts, items) == {(0, 0), (1, 0), (2, 0)}


def test_marks_that_stand_alone_end_a_sentence(spark):
    item = "Tom has 5 apples and gives 2 of them to Anna . How many apples does Anna have then"
    texts = [item.replace("Anna", "Mary Ann").replace("5", "7"), item.replace("Anna", "Mary", 1).replace("Anna", "Peter").replace("5", "7")]
    assert found(spark, texts, [item]) == {(0, 0)}


def test_figures_alone(spark):
    item = "12 + 35 = 47 ; 8 * 9 = 72 ; 5 + 6 = 11"
    assert found(spark, ["See: " + item + " and more", "See: 12 + 36 = 48 ; 8 * 8 = 64 ; 5 + 7 = 12"], [item]) == {(0, 0)}


def test_reparameterised_copies_are_recalled_and_others_are_not(spark):
    rng = random.Random(5)
    filler = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    text = lambda own: " ".join(rng.choices(filler, k=rng.randint(0, 80))) + ". " + own + " " + " ".join(rng.choices(filler, k=rng.randint(0, 80)))
    planted, texts = [], []
    for _ in range(60):
        for k, q in enumerate(QUESTIONS):
            planted.append((len(texts), k))
            texts.append(text(swapped(q, rng)))
    others = len(texts)
    for _ in range(30):
        for q in QUESTIONS[:3]:  # the fourth has 13 words in a row without a name or number, which are enough
            texts.append(text(broken(q, rng)))
            texts.append(text(" ".join(q.split()[: len(q.split()) // 2][:12])))
    got = found(spark, texts, QUESTIONS)
    hit = len(got & set(planted)) / len(planted)
    alarms = sum(d >= others for d, _ in got)
    assert hit >= 0.9 and alarms == 0 and all((d, k) in set(planted) for d, k in got)


def test_a_list_of_versions_of_one_question(spark):
    rng = random.Random(6)
    assert found(spark, [" ".join(swapped(QUESTIONS[0], rng) for _ in range(40)), " ".join(broken(QUESTIONS[0], rng) for _ in range(40))], QUESTIONS[:1]) == {(0, 0)}


def test_judged():
    w = lambda i, j, *pairs: (i, 5, j, pairs)
    assert D.judged([w(0, 100), w(5, 105)], 10) == (1.0, 10, 2)
    assert D.judged([w(0, 100, ("a", "x")), w(5, 105, ("a", "y"))], 10) == (0.0, 0, 0)
    assert D.judged([w(0, 100, ("a", "x")), w(5, 106, ("a", "x"))], 10) == (1.0, 5, 2)
    assert D.judged([w(0, 100, ("a", "x")), w(5, 106, ("a", "y"))], 10) == (0.0, 0, 0)
    assert D.judged([w(0, 100, ("a", "x")), w(5, 105, ("a", "x")), w(0, 103, ("a", "y"))], 10) == (1.0, 10, 2)
    assert D.judged([w(0, 100), w(5, 300)], 10) == (0.5, 5, 1)


@pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver's tables")
def test_against_plain_templates(spark):
    """Brute force: tokens of plain regular expressions, every item against every document at every place, numbers and names free."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{DIR}/benchmark.parquet").select("item_id", "text")
    rng = random.Random(7)
    plain = items.orderBy("item_id").limit(20).collect()
    planted = [(10_000_000 + r.item_id, "It began. " + re.sub(r"\d+", lambda m: str(rng.randint(10, 99)), r.text) + " It ended.") for r in plain]
    both = docs.unionByName(spark.createDataFrame(planted, "doc_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in D.contaminated(both, items).collect()}

    def pattern(text):
        return re.compile(r"(?<!\w)" + r"\W+".join(r"\d[\d.,/]*" if re.fullmatch(r"\d[\d.,/]*", w) else re.escape(w) for w in re.findall(r"\d[\d.,/]*\d|\w+", text.lower())) + r"(?!\w)")

    patterns = [(r.item_id, pattern(r.text)) for r in items.collect()]
    want = {(d.doc_id, i) for d in both.collect() for i, p in patterns if p.search((d.text or "").lower())}
    assert want and want <= got and len(got - want) <= 0.02 * len(want) + 1


def test_common_phrases_alone_propose_nothing(spark):
    """Many items begin and end alike; documents full of that hold none of them, whole items are found all the same."""
    items = [f"Which of the following is the best known name of the {a} {b} that was kept in the old stone tower of the king" for a in ("green", "blue", "dry", "wet", "tall") for b in ("cat", "dog", "fox")]
    phrase = "Which of the following is the best known name of the"
    texts = [f"{phrase} day. " * 30, f"so {items[7]} and on", f"{phrase} red cow that was kept in the old stone tower"]
    got = found(spark, texts, items)
    assert {(d, i) for d, i in got if d == 0} == set() and (1, 7) in got
    every = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    marked = D._with_rarity(D._windows(every, "item_id", "text", 5), 0.8, 13)
    shared = {r["h"] for r in marked.groupBy("h").count().where("count > 5").collect()}
    assert len(shared) > 8 and all(not r["rare"] for r in marked.collect() if r["h"] in shared and r["pos"] < 4)


TEMPLATES = [
    "{A} has {1} apples. {B} buys {2} apples from {A} on Monday. {A} eats {3} pears later. How many apples does {A} have left?",
    "A train leaves {A} at {1} and travels {2} km to {B}. Another train leaves {B} an hour later. Where do the trains from {A} and {B} meet?",
    "Compute {1} * {2} + {3} = ?",
    "What is {1} + {2} - {3} ? Show all steps of the sum.",
    "If {A} is {1} years old and {B} is {2} years older than {A}, how old is {B}?",
    "The bus to {A} leaves at {t} and comes to {B} at {u}. How long does the ride to {B} take?",
    "{A} and {B} share {1} sweets so that {A} gets {2} more than {B}. How many sweets does {B} get?",
    "Solve for x : {1} * x + {2} = {3} and give x as a fraction",
    "Mr {A} drives {1} km in {2} hours. At what speed in km per hour did {A} drive?",
    "On {t} o'clock {A} met {B} in {C}. Who came to {C} first, {A} or {B}?",
    "A shop in {A} sells {1} kg of rice for {2} dollars. What do {3} kg of rice cost in {A}?",
]


def filled(template: str, rng: random.Random, names: list[str], same: bool = True) -> str:
    value = {x: str(rng.randint(10, 999)) for x in "123"} | {x: f"{rng.randint(1, 12)}:{rng.randint(10, 59)}" for x in "tu"} | dict(zip("ABC", rng.sample(names, 3), strict=True))
    fresh = lambda x: value[x] if same else str(rng.randint(1000, 9999)) if x in "123tu" else rng.choice(names) + "son" + chr(97 + rng.randrange(26))
    return re.sub(r"\{(\w)\}", lambda m: fresh(m[1]), template)


def test_recall_in_any_case_and_over_many_templates(spark):
    """In each manner of copying at least 0.9 of the copies with other names and figures are found, and no copy whose values disagree."""
    rng = random.Random(11)
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    around = lambda own: " ".join(rng.choices(words, k=rng.randint(5, 80))) + ". " + own + " " + " ".join(rng.choices(words, k=rng.randint(5, 80)))
    items = [filled(x, rng, ["Tom", "Anna", "Paris", "Lyon", "Bob", "Ulm"]) for x in TEMPLATES]
    manners = {"as written": lambda x: x, "inside text": around, "lower case": lambda x: around(x.lower()), "upper case": lambda x: around(x.upper())}
    texts, of = [], []
    for manner, way in manners.items():
        for k, x in enumerate(TEMPLATES):
            for _ in range(5):
                texts.append(way(filled(x, rng, NAMES)))
                of.append((manner, k))
    for k, x in enumerate(TEMPLATES):
        # 13 words in a row without a name are enough by themselves.
        if (x.count("{A}") > 1 or x.count("{B}") > 1) and max(len(part.split()) for part in re.split(r"\{[ABC]\}", x)) < 13:
            for way in manners.values():
                texts.append(way(filled(x, rng, NAMES, same=False)))
                of.append(("broken", k))
        texts.append(around(" ".join(filled(x, rng, NAMES).split()[: len(x.split()) // 2])))
        of.append(("half", k))
    got = found(spark, texts, items)
    rate = {m: sum((d, k) in got for d, (w, k) in enumerate(of) if w == m) / sum(w == m for w, _ in of) for m in [*manners, "broken", "half"]}
    wrong = [(texts[d], items[k]) for d, k in got if of[d][1] != k]
    broken_found = [(texts[d], items[k]) for d, k in got if of[d][0] == 'broken']
    assert min(rate[m] for m in manners) >= 0.9 and not wrong and rate["half"] == 0 and rate["broken"] == 0, (rate, wrong, broken_found)
