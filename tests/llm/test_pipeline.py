"""The pipeline over written tables against a brute-force version of its near copies."""

import random

import corpus_pipeline

from dispatchlake.llm import mixing, sharding, toxicity
from pyspark.sql import functions as F

from .test_operators import ITEMS, base_rows, brute_groups, brute_hits, brute_targets, near_copies

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def written(spark, folder, texts):
    """One source, clean labels and a benchmark that nothing holds: only near copies go."""
    docs = [(d, t, "en", "web", len(t)) for d, t in texts]
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, 1, 0) for d, _ in texts], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this item stands in any of the documents that are written here")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_pipeline_drops_near_copies_of_five_words(spark, tmp_path):
    rng = random.Random(3)
    base = [f"p{i}" for i in range(100)]
    other = list(base)
    # 86 of 106 shingles of five words (0.811) are shared, but only 89 of 105 of four (0.848)
    other[30], other[60] = "q30", "q60"
    texts = [(1, " ".join(base)), (2, " ".join(other)), *near_copies(4), *((2000 + i, " ".join(f"v{rng.randrange(10**6)}" for _ in range(20))) for i in range(40))]
    assert {c for _, _, c in brute_groups(texts[:2], 5, 80)} == {1} and {c for _, _, c in brute_groups(texts[:2], 4, 85)} == {1, 2}
    written(spark, tmp_path, texts)
    want = sorted({c for _, _, c in brute_groups(texts, 5, 80)})
    assert len(want) < len(texts) and want != sorted({c for _, _, c in brute_groups(texts, 4, 85)})
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r["doc_id"] for r in out.collect()) == want


CLASH = {c: c for c in ("doc", "key", "address", "n", "part", "row", "toxicity", "score", "n_words", "spans", "items", "own_spans", "times", "_source", "of", "hash")}


def odd_rows():
    """Nulls, empty and long texts, no ids, repeats, copies, benchmark passages, slurs."""
    rng = random.Random(12)
    rows = [(d, t, rng.choice(["web", "code", None])) for d, t in base_rows(near_copies(6))]
    rows += [(3000 + i, ITEMS[0][1] + " " + " ".join(f"z{rng.randrange(10**6)}" for _ in range(rng.choice((5, 2000)))), "web") for i in range(20)]
    rows += [(4000 + i, " ".join(rng.choice(["moron", "scum"]) if i % 2 and j % 4 == 0 else f"t{rng.randrange(200)}" for j in range(30)), "forum") for i in range(300)]
    rows += [(None, "no id at all but a few words", None)] * 3 + [rows[40]] * 2 + [(5000, None, None), (5001, "", "only empty")]
    return rows


def test_each_stage_on_odd_rows(spark, tmp_path):
    rows = odd_rows()
    docs = spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in rows], DOCS).repartition(3).withColumns({c: F.lit(v) for c, v in CLASH.items()})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(4000 + i, 1, i % 2) for i in range(300)] + [(None, 1, 1), (4001, 0, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(i, t) for i, t in ITEMS if t != "solo"], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages, folder = dict(corpus_pipeline.STAGES), str(tmp_path)
    out = {}
    for name in ("toxicity", "near_copies", "decontamination", "mixing"):
        kept = stages[name](spark, docs, folder)
        assert kept.columns == docs.columns
        out[name] = kept.collect()
        assert {tuple(r[c] for c in CLASH) for r in out[name]} == {tuple(CLASH.values())}
        assert stages[name](spark, docs.limit(0), folder).count() == 0
    plain = lambda found: sorted((str(r["doc_id"]), str(r["text"]), str(r["source"])) for r in found)
    # toxicity: what the trained weights say of each row alone
    scored = toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))).filter("score < 0.5").collect()
    assert plain(out["toxicity"]) == plain(scored)
    forum = [r["doc_id"] for r in out["toxicity"] if r["source"] == "forum"]
    assert sum(i % 2 for i in forum) <= 5 and sum(1 - i % 2 for i in forum) >= 145 and len(out["toxicity"]) >= len(rows) - 155
    # near copies: one of each group
    groups = brute_groups([(d, t) for d, t, _ in rows], 5, 80)
    with_words = [x for x in groups if x[1]]
    lost = {t for d, t, _ in rows if d is None and (t or "").split()}
    assert sorted(str(r["doc_id"]) for r in out["near_copies"] if (r["text"] or "").split()) == sorted([str(c) for c in {c for d, _, c in with_words if c is not None}] + ["None"] * len(lost))
    assert sum(not (r["text"] or "").split() for r in out["near_copies"]) == sum(not (t or "").split() for _, t, _ in rows)
    # decontamination: the contract's rule
    clean = []
    for d, t, s in rows:
        w, hit, _ = brute_hits(t, [x for x in ITEMS if x[1] != "solo"])
        if not hit or 20 * len(hit) < len(w):
            clean.append((str(d), str(t), str(s)))
    assert plain(out["decontamination"]) == sorted(clean) and len(clean) < len(rows)
    # mixing: near each target, no row more than three times its own number
    sizes, taken = {}, {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    for r in out["mixing"]:
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
    longest = max(len((t or "").split()) for _, t, _ in rows)
    for s, target in brute_targets(sizes).items():
        assert abs(taken.get(s, 0) - target) <= longest
    # sharding: the filled table, for every row
    table = sharding.fill()
    placed = stages["sharding"](spark, docs, folder)
    assert placed.columns == [*docs.columns, "slot", "shard"] and plain(placed.collect()) == plain(docs.collect())
    assert all(r["shard"] == table[r["slot"]] for r in placed.collect())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "decontamination", "mixing", "sharding"]
    assert set(corpus_pipeline.run(spark, folder).columns) == {*docs.columns, "slot", "shard"}
    assert mixing.mix(docs).count() == len(rows)
