"""corpus_pipeline.run over the smallest tables, each stage recomputed apart from its operator but for the classifier, whose decisions are op8's."""

import os
import re
import zlib

import numpy as np
import pytest

from eventloom.llm import queries as Q
from eventloom.llm.toxicity import drop_toxic

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver's tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def without_near_copies(docs):
    """The smallest doc_id of each group linked by a Jaccard similarity of 0.8 over sets of five words in lower case."""
    sets = {}
    for d, text in docs.items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    of = {d: d for d in docs}
    ids = sorted(docs)
    while True:
        changed = False
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                x, y = sets[a], sets[b]
                if of[a] != of[b] and (len(x & y) >= 0.8 * len(x | y) - 1e-9):
                    of[a] = of[b] = min(of[a], of[b])
                    changed = True
        if not changed:
            return {d: docs[d] for d in ids if of[d] == d}


def without_passages(docs):
    split = {d: WORD.findall(t) for d, t in docs.items()}
    first = {}
    for d in sorted(split):
        for i in range(len(split[d]) - 12):
            first.setdefault(tuple(split[d][i : i + 13]), d)
    out = {}
    for d, text in docs.items():
        gone = set()
        for i in range(len(split[d]) - 12):
            if first[tuple(split[d][i : i + 13])] < d:
                gone.update(range(i, i + 13))
        spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text)]
        lead = text[: spans[0][0]] if spans else text
        out[d] = text if not gone else lead + "".join(text[s:e] for k, (s, e) in enumerate(spans) if k not in gone)
    return out


def test_run(spark):
    import corpus_pipeline
    from tokenizers import Tokenizer

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()}
    toxic = {r.doc_id for r in Q.op8_toxicity(spark, DIR).where("predicted = 1").select("doc_id").collect()}
    assert 0 < len(toxic) < len(docs) / 2
    left = without_near_copies({d: t for d, t in docs.items() if d not in toxic})
    left = without_passages(left)
    plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [plain(r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").select("text").collect()]
    holds = {d for d, t in left.items() if any(i in plain(t) for i in items)}
    got = corpus_pipeline.run(spark, DIR).toPandas()
    assert set(got.doc_id).isdisjoint(holds) and set(got.doc_id) <= set(left)
    # Edited copies of items may go too, but few do.
    assert len(set(left) - holds - set(got.doc_id)) <= 2
    t = Tokenizer.from_file(Q._tokenizer())
    for d, own in got.sort_values("piece").groupby("doc_id"):
        ids = [*t.encode(left[d], add_special_tokens=False).ids, 0]
        assert list(own.length) == [len(ids[i : i + 2048]) for i in range(0, len(ids), 2048)]
        assert list(own.ids_crc32) == [zlib.crc32(np.array(ids[i : i + 2048], "<u4").tobytes()) for i in range(0, len(ids), 2048)]
    ends = got.sort_values("offset").groupby("sequence_id").apply(lambda s: (s.offset.values == np.concatenate([[0], np.cumsum(s.length.values)[:-1]])).all() and s.length.sum() <= 2048, include_groups=False)
    assert ends.all()


def test_toxicity_stage_keeps_what_the_query_accepts(spark):
    docs, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    kept = drop_toxic(docs, labels)
    accepted = {r.doc_id for r in Q.op8_toxicity(spark, DIR).where("predicted = 0").select("doc_id").collect()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.select("doc_id").collect()} == accepted


def test_run_on_empty_tables(spark, tmp_path):
    """No documents; and documents without labels and benchmark, of which only copies go."""
    import corpus_pipeline

    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{DIR}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"none/{name}.parquet"))
        spark.read.parquet(f"{DIR}/{name}.parquet").limit(0 if name != "documents" else 20).write.parquet(str(tmp_path / f"some/{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path / "some")).select("doc_id").collect()}
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(str(tmp_path / "some/documents.parquet")).collect()}
    assert kept == set(without_near_copies(docs))
