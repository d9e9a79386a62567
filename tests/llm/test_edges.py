"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for each operator and stage."""

import os
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import chat, decontamination, embeddings, packing, scoring, sharding, simhash, store, substring, toxicity
from eventloom.llm.queries import _tokenizer

CLASH = ["fp", "rep", "key", "chunk", "n", "h", "id", "size", "shard", "slot", "piece", "start", "n_words", "kept_sha256", "n_removed", "row", "score", "_gone", "k1", "component_id", "text_key"]
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi " * 3000


def table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("x") for c in CLASH})


@pytest.fixture(scope="module")
def odd(spark):
    texts = [(0, None), (1, ""), (2, " \n\t"), (3, "one"), (4, "one"), (4, "one"), (None, "one"), (5, LONG), (6, LONG), (7, "Ünïcode   words… and 😀 marks!! don't " * 9), (None, None)]
    return table(spark, [(i, t, None, None, None) for i, t in texts])


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_simhash(odd, none):
    got = simhash.near_duplicates(odd)
    assert got.count() == 11
    rows = {(r.doc_id, r.component_id) for r in got.collect()}
    assert {(0, 0), (1, 0), (2, 0), (3, 3), (4, 3), (None, 3), (None, 0), (5, 5), (6, 5)} <= rows
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {0, 3, 5, 7, None}


def test_simhash_masks_cover_every_four_bits():
    from itertools import combinations

    masks = simhash.covering_masks(4)
    assert len(masks) == 31 and all(16 < m.bit_count() < 48 for m in masks)
    rng = np.random.default_rng(0)
    some = [tuple(rng.choice(64, 4, replace=False)) for _ in range(2000)] + list(combinations(range(64), 2))
    assert all(any(not any(m >> int(i) & 1 for i in s) for m in masks) for s in some)


def test_large_buckets_are_compared_in_blocks(spark):
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{k}" for k in range(200)) + "".join(f" x{v}" for v in rng.integers(0, 3, 2)) for _ in range(60)]
    texts += [" ".join(f"w{v}" for v in rng.integers(0, 9, 30)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert by_id(simhash.near_duplicates(docs, block=3)) == by_id(simhash.near_duplicates(docs))
    x = rng.standard_normal((6, 16))
    vectors = [(i, (x[i % 6] + 0.05 * rng.standard_normal(16)).tolist(), 1) for i in range(90)]
    e = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int")
    assert by_id(embeddings.near_duplicates(e, block=4)) == by_id(embeddings.near_duplicates(e))


def test_embeddings(spark):
    a, b = [1.0, 0.0, 0.5], [1.0, 0.01, 0.5]
    rows = [(0, a, 1), (1, a, 1), (2, b, 1), (3, a, 2), (4, a, None), (5, None, 1), (6, [0.0] * 3, 1), (7, [1.0, None, 0.5], 1), (8, [1.0, float("nan"), 0.5], 1), (9, [float("inf"), 0.0, 0.0], 1), (10, [], 1), (11, [1.0, 0.0], 1), (None, a, 1), (2, b, 1)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("key", F.lit(1)).withColumn("rep", F.lit(2))
    got = by_id(embeddings.near_duplicates(e))
    assert got == by_id(spark.createDataFrame([(0, 3, 0, True), (1, 3, 0, False), (2, 3, 0, False), (2, 3, 0, False), *[(i, 0, i, True) for i in range(3, 12)], (None, 0, None, True)], "a long, b long, c long, d boolean"))
    assert embeddings.near_duplicates(e.limit(0)).count() == 0


def test_embeddings_with_ids_that_come_again(spark):
    """An id may name several vectors, under one label or two: each row is judged by its own."""
    x, near, y, z = [1.0, 0.0, 0.0], [1.0, 0.01, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    e = spark.createDataFrame([(1, 1, x), (2, 1, near), (1, 2, y), (1, 1, z), (0, 1, x), (5, 2, y)], "vec_id long, label int, embedding array<double>")
    got = by_id(embeddings.near_duplicates(e))
    assert got == sorted([(1, 2, 0, False), (2, 2, 0, False), (1, 1, 1, True), (1, 0, 1, True), (0, 2, 0, True), (5, 1, 1, False)], key=str)


def test_embeddings_chain(spark):
    angle = [0.0, 0.3, 0.6, 2.0]  # each cos 0.3 = 0.955 from the next, 0.825 from the one after
    e = spark.createDataFrame([(i, [float(np.cos(t)), float(np.sin(t))], 1) for i, t in enumerate(angle)], "vec_id long, embedding array<double>, label int")
    assert [tuple(r)[1:3] for r in embeddings.near_duplicates(e).orderBy("vec_id").collect()] == [(1, 0), (2, 0), (1, 0), (0, 3)]


def test_chat(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "a[INST]\\"), (1, 0, None, "a[INST]\\"), (1, None, "system", "<<SYS>>"), (None, 0, "user", "lost"), (2, 5, "tool", "]x["), (3, 0, "assistant", "é😀")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"tree": F.lit(1), "id": F.lit(1), "score": F.lit(1)})
    got = {r.tree: list(chat.parse_turns(r.text)) for r in chat.formatted(chat.threads(turns)).collect()}
    assert got == {1: [("system", "<<SYS>>"), ("", "a[INST]\\"), ("", "a[INST]\\"), ("assistant", "")], 2: [("tool", "]x[")], 3: [("assistant", "é😀")]}
    assert chat.read_back(chat.formatted(chat.threads(turns.limit(0)))).count() == 0


def test_chat_query_keeps_the_conversation_without_an_id(spark, tmp_path):
    from eventloom.llm.queries import op2_chat

    rows = [(None, 0, "user", "hi"), (None, 1, "assistant", "yes"), (None, 2, "user", "so"), (1, 0, "user", "a")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert {(r.conv_id, r.n_turns, r.loss_chars) for r in op2_chat(spark, str(tmp_path)).collect()} == {(None, 3, 3), (1, 1, 0), (-1, 2, 21)}


def test_reply_tree(spark):
    links = [(1, None, 0.0), (2, 1, 1.0), (3, 1, 5.0), (4, 2, 9.0), (5, 4, 9.0), (6, 3, 0.0), (7, 99, 1.0), (8, 9, 1.0), (9, 8, 1.0)]
    m = spark.createDataFrame([(0, i, p, s, "user", f"m{i}") for i, p, s in links], "tree long, id long, parent long, score double, role string, text string")
    found = {r.leaf: (r.rank, [t for _, t in chat.parse_turns(r.text)]) for r in chat.formatted(m).collect()}
    assert found == {5: (1, ["m1", "m2", "m4", "m5"]), 6: (2, ["m1", "m3", "m6"]), 7: (3, ["m7"])}
    assert [r.leaf for r in chat.formatted(m, keep=1).collect()] == [5]
    chain = spark.createDataFrame([(0, i, i - 1 if i else None, 0.0) for i in range(100)], "tree long, id long, parent long, score double")
    assert [r.id for r in chat.paths(chain).orderBy("depth").collect()] == list(range(100))


@pytest.mark.parametrize("text", ["", "</s>[INST] ok [/INST]", "\\", "\\\\[", "<<SYS>>", "[ROLE][/ROLE]", "a\n<s>"])
def test_template_is_reversible(text):
    turns = [("user", text), ("assistant", text), ("system", text), ("weird [/ROLE]", text), ("assistant", "x")]
    whole, spans = chat.format_turns(turns)
    assert list(chat.parse_turns(whole)) == turns and [chat.unescape(whole[s:e]) for s, e in spans] == [text, "x"]


def test_scoring(odd, none):
    got = {(r.doc_id, r.n_tokens) for r in scoring.scored(odd).collect()}
    assert {(0, 1), (1, 1), (2, 1), (3, 2), (4, 2), (None, 2), (None, 1), (5, 42001)} <= got
    assert scoring.scored(odd).count() == 11 and scoring.scored(none).count() == 0


def test_scoring_does_not_depend_on_chunks(spark):
    rng = np.random.default_rng(3)
    docs = spark.createDataFrame([(i, " ".join(f"w{v}" for v in rng.zipf(1.5, 80) % 50)) for i in range(120)], "doc_id long, text string")
    a, b = (sorted((r.doc_id, round(r.score, 5)) for r in scoring.scored(docs, least=4, bits=1.0, mb=mb).collect()) for mb in (10.0, 0.004))
    assert a == b


class Tree:
    """The suffix tree by plain counting, over one list of token lists."""

    def __init__(self, train, least, bits):
        seqs = [["<", *t] for t in train]
        self.c = Counter(w for t in train for w in t)
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.states = {}
        counts = {1: Counter(), 2: Counter()}
        for t in seqs:
            for d in (1, 2):
                counts[d].update((tuple(t[i - d : i]), t[i]) for i in range(d, len(t)))
        totals = {1: {(w,): k for w, k in self.c.items()} | {("<",): self.c[None]}}
        # A longer context is known by its pair, if that one was asked for and seen twice.
        totals[2] = {(*s, w): k for (s, w), k in counts[1].items() if k >= 2 and totals[1].get(s, 0) >= least}
        for d in (1, 2):
            found = {}
            for (s, w), k in counts[d].items():
                if totals[d].get(s, 0) >= least and k >= 2:
                    found.setdefault(s, {})[w] = k
            new = {}
            for s, kept in found.items():
                n, m = totals[d][s], sum(kept.values())
                gain = 0.0
                for w, k in kept.items():
                    eighths = min(round(-8 * np.log2(self.p(s[1:], w))), 255)
                    gain += k * max(np.log2(max(k - 1 - 0.75, 0.05) / max(n - 1, 1)) + eighths / 8, -4)
                left = (n - m + 0.75 * len(kept)) / n
                if gain + (n - m) * np.log2(max(left, 1e-12)) > bits:
                    new[s] = (n, kept, left)
            self.states |= new

    def p(self, s, w):
        if not s:
            return (self.c[w] + 0.1) / (self.n + 0.1 * (self.v + 1))
        lower = self.p(s[1:], w)
        if s not in self.states:
            return lower
        n, kept, left = self.states[s]
        return (kept[w] - 0.75) / n * (w in kept) + left * lower if w in kept else left * lower

    def score(self, t):
        t = ["<", *t]
        return sum(np.log10(self.p(tuple(t[max(0, i - 2) : i]), t[i])) for i in range(1, len(t)))


def test_scoring_is_the_suffix_tree(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["a b c", "a c", "d", "e a b", "f g h i", "x" + str(rng.integers(0, 40))], 12, p=[0.2, 0.2, 0.2, 0.2, 0.15, 0.05])) for _ in range(200)]
    tokens = [[*t.split(), None] for t in texts]
    tree = Tree([t for i, t in enumerate(tokens) if zlib.crc32(str(i).encode()) % 10], 8, 2.0)
    assert {len(s) for s in tree.states} == {1, 2}
    for s in [(), *tree.states]:
        assert np.isclose(sum(tree.p(s, w) for w in [*tree.c, "unheard of"]), 1)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in scoring.scored(df, least=8, bits=2.0, mb=0.003).collect()}
    assert np.allclose([got[i] for i in range(200)], [tree.score(t) for t in tokens], rtol=1e-9)


def test_packing(odd, none):
    found = packing.packed(odd, _tokenizer(), capacity=64, keep_ids=True)
    assert found.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 64").count() == 0
    assert found.where("doc_id = 0").select("length").collect()[0][0] == 1 and found.where("doc_id = 4").count() == 2
    whole = packing.sequences(found)
    assert whole.where(F.length("ids") != 4 * F.col("length")).count() == 0
    assert packing.packed(none, _tokenizer()).count() == 0


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    b = packing.BestFit(10, 2)
    assert [b.place(n) for n in (6, 5, 4, 5)] == [(0, 0), (1, 0), (0, 6), (1, 5)]
    c = packing.BestFit(10, 2)
    assert [c.place(n)[0] for n in (7, 6, 9, 3, 4)] == [0, 1, 2, 1, 3]  # bin 0, though 3 would fill it, was closed for the 9


def test_substring(spark, odd, none):
    got = substring.deduplicated(odd)
    rows = {(r.doc_id, r.n_words, r.n_removed) for r in got.collect()}
    assert {(0, 0, 0), (1, 0, 0), (2, 0, 0), (3, 1, 0), (None, 1, 0), (5, 42000, 0), (6, 42000, 42000)} <= rows and got.count() == 11
    assert got.where("doc_id = 6").first().text == "" and got.where("doc_id = 0").first().text is None
    assert substring.deduplicated(none).count() == 0
    w = [f"t{i}" for i in range(40)]
    docs = spark.createDataFrame([(9, " ".join(w)), (3, "a  b\n" + "\t".join(w[5:18]) + "\nend"), (4, " ".join(w[5:17]) + " z"), (10, " ".join(w[20:33]) + " q " + " ".join(w[5:18]))], "doc_id long, text string")
    left = {r.doc_id: r.text for r in substring.deduplicated(docs).collect()}
    assert left == {3: "a  b\n" + "\t".join(w[5:18]) + "\nend", 4: " ".join(w[5:17]) + " z", 9: " ".join(w[:5] + w[18:]), 10: "q "}
    many = {r.doc_id: r.text for r in substring.deduplicated(docs, mb=0.0001).collect()}
    assert many == left


def test_store(spark, odd, none, tmp_path):
    store.write_store(odd, str(tmp_path / "a"), _tokenizer())
    sums = store.read_digests(spark, str(tmp_path / "a")).orderBy("start").collect()
    ids = store.read_ids(spark, str(tmp_path / "a")).orderBy("start").collect()
    assert len(sums) == len(ids) == 11 and [r.n_tokens for r in sums] == [len(r.ids) // 2 for r in ids]
    assert [r.start for r in sums] == list(np.cumsum([0, *[r.n_tokens for r in sums]])[:-1])
    assert [r.ids_crc32 for r in sums] == [zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) for r in ids]
    assert sorted(str(r.doc_id) for r in sums) == sorted(str(r.doc_id) for r in odd.collect()) and [r.doc_id for r in sums if r.doc_id is not None] == [0, 1, 2, 3, 4, 4, 5, 6, 7]
    chunks = spark.read.parquet(str(tmp_path / "a/chunks")).where("payload IS NOT NULL")
    assert chunks.count() == chunks.select("hash").distinct().count()
    store.write_store(none, str(tmp_path / "b"), _tokenizer())
    assert store.read_digests(spark, str(tmp_path / "b")).count() == 0


def test_store_finds_damage(spark, odd, tmp_path):
    path = str(tmp_path / "c")
    store.write_store(odd, path, _tokenizer())
    chunks = spark.read.parquet(f"{path}/chunks")
    chunks.withColumn("payload", F.when(F.col("payload").isNotNull(), F.concat("payload", F.lit(b"\0\0")))).write.parquet(f"{path}-x/chunks")
    for t in ("recipes", "manifest"):
        spark.read.parquet(f"{path}/{t}").write.parquet(f"{path}-x/{t}")
    with pytest.raises(Exception, match="payload"):
        store.read_digests(spark, f"{path}-x").collect()


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(None, 1), (3, None), (4, 0)], "doc_id long, toxic int").withColumn("text", F.lit("x"))
    got = toxicity.scored(odd, toxicity.fit(odd, labels))
    assert got.count() == 11 and got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    docs = table(spark, [(i, ("you utter moron and scum " if i % 3 == 0 else "a calm and kind remark ") + f"number {i}", None, None, None) for i in range(90)])
    known = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    assert {(r.predicted, r.doc_id % 3 == 0) for r in toxicity.scored(docs, model).collect()} == {(1, True), (0, False)}
    kept = toxicity.drop_toxic(docs, known)
    assert kept.columns == docs.columns and kept.count() == 60
    assert toxicity.scored(none, model).count() == 0 and toxicity.drop_toxic(odd, known).count() == 11


def test_toxicity_fits_on_one_row_a_document(spark):
    texts = [("you utter moron and scum " if i % 3 == 0 else "a calm and kind remark ") + f"number {i}" for i in range(90)]
    docs = table(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    known = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    hot = next(i for i in range(1, 90, 3) if zlib.crc32(str(i).encode()) % 5)
    more = docs.union(table(spark, [(hot, "you utter moron and scum " + texts[hot], None, None, None)] * 500))
    a, b = toxicity.fit(docs, known), toxicity.fit(more, known)
    assert a.entries == b.entries and a.bias == b.bias and (a.weights == b.weights).all()


def test_label_model_shares_the_weight_of_copies():
    rng = np.random.default_rng(5)
    y = rng.random(4000) < 0.3
    vote = lambda acc: (rng.random(4000) < np.where(y, acc, 1 - acc)).astype(np.uint8)
    good, noisy = vote(0.85), vote(0.6)
    fires = np.column_stack([good, noisy, noisy, noisy, vote(0.85), vote(0.9)])
    post, a1, _, share = toxicity.label_model(fires)
    assert share[1] < 0.5 < share[0] and abs(a1[0] - 0.85) < 0.08 and ((post > 0.5) == y).mean() > 0.9


def test_decontamination(spark, odd, none):
    items = spark.createDataFrame([(1, "Tom has 5 apples and gives 2 of them to Anna . How many apples does Anna have then"), (2, None), (3, ""), (4, "tiny text"), (None, "a b c d e f")], "item_id long, text string").withColumn("h", F.lit(1))
    swapped = "Tom has 9 apples and gives 3 of them to Mary . How many apples does Mary have then"
    broken = "Tom has 9 apples and gives 3 of them to Mary . How many apples does Peter have then"
    docs = table(spark, [(1, "Before it . " + swapped + " . After", None, None, None), (2, broken, None, None, None), (3, "quite a tiny text here", None, None, None), (4, "tiny words of text", None, None, None), (None, swapped, None, None, None)])
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()}
    assert got == {(1, 1), (None, 1), (3, 4)}
    assert decontamination.contaminated(odd, items).count() == 0
    assert decontamination.contaminated(none, items).count() == 0 and decontamination.contaminated(docs, items.limit(0)).count() == 0
    kept = decontamination.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.orderBy("doc_id").collect()] == [2, 4]


def test_decontamination_without_broadcast(spark, monkeypatch):
    items = spark.createDataFrame([(1, "one red fox ran over 7 km of the old hill")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "so one red fox ran over 12 km of the old hill"), (2, "one red fox ran")], "doc_id long, text string")
    a = by_id(decontamination.contaminated(docs, items))
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", -1)
    monkeypatch.setattr(decontamination, "WHOLE_BYTES", 9)
    assert by_id(decontamination.contaminated(docs, items)) == a and len(a) == 1


def test_decontamination_of_items_that_are_mostly_placeholders(spark):
    texts = ["Compute 12 * 7 + 3 = ?", "Heights 120cm 130cm 140 cm 150cm", "with Anna Bob Carl Dora Emil Franz"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    others = ["Compute 13 * 8 + 4 = ?", "Heights 120cm 131cm 140 cm 150cm", "with Bob Anna Dora Carl Franz Emil"]
    docs = spark.createDataFrame([(i, f"so then {t} and on") for i, t in enumerate(texts + others)], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()} == {(0, 0), (3, 0), (1, 1), (2, 2)}


def test_decontamination_of_copies_with_other_case_and_marks(spark):
    item = "Early on a Monday Anna took 4 of the boats over to the mill. Then she met Bob near the old bridge. Why did he not bring any of his 9 ropes?"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    bare = item.replace(".", "").replace("?", "")
    forms = [item, bare, item.title(), item.upper(), item.lower(), bare.lower().replace("4", "6").replace("9", "2")]
    docs = spark.createDataFrame([(i, f"he said {t} and went on") for i, t in enumerate(forms)], "doc_id long, text string")
    assert {r.doc_id for r in decontamination.contaminated(docs, items).collect()} == set(range(len(forms)))


def test_decontamination_of_edited_and_partial_items(spark):
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(40)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:20]) + " tail")], "item_id long, text string")

    def edited(*at):
        return " ".join("other" if k in at else w for k, w in enumerate(words))

    texts = [edited(7), edited(7, 21), edited(7, 21, 30), " ".join(words[:30]), " ".join(words[22:35]), " ".join(words[22:34]), edited(*range(3, 40, 4)), " ".join(words[:26]).upper()]
    docs = spark.createDataFrame([(i, f"so {t} then") for i, t in enumerate(texts)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.coverage for r in decontamination.contaminated(docs, items).collect()}
    assert {d for d, i in got if i == 1} == {0, 1, 2, 3, 4, 7} and {d for d, i in got if i == 2} == {0, 1, 2, 3, 7}
    assert abs(got[0, 1] - 39 / 40) < 1e-9 and abs(got[4, 1] - 13 / 40) < 1e-9
    # One name out of step with the others: what is met word by word still counts.
    item = "Then Anna said that the old boat was on the far side of the mill and that nobody but Anna could row it"
    docs = spark.createDataFrame([(1, "x. " + item.replace("but Anna", "but Mary"))], "doc_id long, text string")
    assert decontamination.contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).count() == 1


def test_sharding(spark, odd, none, tmp_path):
    got = sharding.assign(odd, 3)
    assert got.count() == 11 and {r.shard for r in got.collect()} <= {0, 1, 2}
    assert sharding.assign(none).count() == 0
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("y"), (F.col("id") % 7).cast("int")).alias("text"))
    for law, column in (("rows", F.count("*")), ("bytes", F.sum("size"))):
        sizes = [r[1] for r in sharding.assign(docs, 7, law).groupBy("shard").agg(column).collect()]
        assert len(sizes) == 7 and max(sizes) - min(sizes) <= (1 if law == "rows" else 28)  # a boundary lies within half a row, of 14 bytes at most, of its due
    sharding.write_shards(docs, str(tmp_path / "s"), 5)
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("shard").count().count() == 5
    with pytest.raises(ValueError):
        sharding.assign(docs, 3, "other")


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the driver's tables")
def test_stages_keep_the_columns(spark, odd):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, odd, "/root/testdata/sf0.001")
        assert got.columns == odd.columns, name
        assert got.count() >= 5 and stage(spark, odd.limit(0), "/root/testdata/sf0.001").count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, odd, "/root/testdata/sf0.001").count() >= 11


def test_a_chunk_that_every_batch_has_is_stored_once(spark, tmp_path):
    """However many groups its copies first meet in."""
    notice = " ".join(f"word{i % 97} of the notice {i}" for i in range(600))
    docs = spark.createDataFrame([(i, f"{notice} text {i} " + f"own{i} " * 50) for i in range(60)], "doc_id long, text string").repartition(12)
    found = {}
    for copies in (1e-6, 32_768):
        path = str(tmp_path / f"s{copies}")
        store.write_store(docs, path, _tokenizer(), copies=copies)
        chunks = spark.read.parquet(f"{path}/chunks").where("kind = 'chunk'")
        assert chunks.groupBy("hash").count().agg(F.max("count")).first()[0] == 1
        found[copies] = (sorted(bytes(r[0]) for r in chunks.select("hash").collect()), by_id(store.read_digests(spark, path)))
    assert found[1e-6] == found[32_768] and len(found[1e-6][1]) == 60


def test_rows_that_come_again_are_spread(spark):
    """100,000 rows without an id, and as many copies of one row: no chunk and no group has more than its share."""
    from eventloom.llm.cells import chunked
    from eventloom.llm.common import dealt_by

    docs = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("some words of a text").alias("text"))
    chunks = chunked(docs, 2_000_000, 0.1).groupBy("chunk").count().collect()
    assert len(chunks) == 20 and max(r["count"] for r in chunks) < 6000
    found = docs.select("doc_id", F.lit(0).alias("piece"), F.lit(7).cast("long").alias("length"))
    groups = [r["count"] for r in found.groupBy(dealt_by(10).alias("g")).count().collect()]
    assert len(groups) == 10 and max(groups) < 11_000
    places = packing.pack(found, 20, group=10_000).groupBy("sequence_id").agg(F.count("*").alias("n"), F.collect_set("offset").alias("at")).collect()
    assert sum(r["n"] for r in places) == 100_000 and all(sorted(r["at"]) == [0, 7][: r["n"]] for r in places) and len(places) <= 50_010
    assert packing.pack(found, 20, group=10_000).select(F.shiftright("sequence_id", 32).alias("g")).groupBy("g").count().agg(F.max("count")).first()[0] < 11_000


def test_scoring_with_a_word_that_is_a_third_of_all(spark):
    """A hot context's statistics go to every chunk: the same scores whether documents are one chunk or many."""
    import random

    rng = random.Random(4)
    texts = [" ".join("the" if rng.random() < 0.33 else f"w{rng.randrange(40)}" for _ in range(60)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    few = {r["doc_id"]: r["score"] for r in scoring.scored(docs, mb=12.0).collect()}
    many = {r["doc_id"]: r["score"] for r in scoring.scored(docs, mb=0.004).collect()}
    assert few.keys() == many.keys() and all(abs(few[i] - many[i]) < 1e-9 for i in few)
