"""The pipeline stage by stage against plain versions, and as a whole."""

import re

import pytest

import corpus_pipeline as cp
from orrery.llm import language_id, pieces, pii

from test_llm_operators import brute_contamination, brute_fingerprint, connected

SMALL = "/root/testdata/sf0.001"
TABLE_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage got and gave."""
    docs, seen = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in cp.STAGES:
        before = docs
        docs = cp.materialise(stage(spark, docs, SMALL), name)
        seen.append((name, before, docs))
    return seen


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns_and_names(stages):
    assert 4 <= len(stages) <= 5
    for _, _, after in stages[:-1]:
        assert after.columns == TABLE_COLUMNS
    assert stages[-1][2].columns == [*TABLE_COLUMNS, *pieces.RESULTS]


def test_language_stage_keeps_what_has_a_language(stages):
    _, before, after = stages[0]
    model = language_id.fit(before)
    found = language_id.predict(before, model, ["doc_id"]).collect()
    assert ids(after) == {r.doc_id for r in found if r.lang_pred != "und" and r.score >= cp.MIN_SCORE}
    lettered = {r.doc_id for r in before.collect() if any(c.isalpha() for c in r.text or "")}
    assert ids(after) <= lettered and len(ids(after)) >= 0.95 * len(lettered)


def test_near_dedup_stage_keeps_one_of_each_group(stages):
    _, before, after = stages[1]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    codes = [brute_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (codes[i] ^ codes[j]).bit_count() <= 4]
    component = connected(len(rows), pairs)
    assert ids(after) == {rows[c][0] for c in component} and after.count() == len(set(component))


def test_decontamination_stage_drops_contaminated_documents(spark, stages):
    _, before, after = stages[2]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    kept = set()
    for row in before.collect():
        (found,) = brute_contamination([(row.doc_id, row.text)], items, 13)
        _, n, hit = re.match(r"\((\d+), (\d+), (\d+)", found).groups()
        if not (int(hit) and 20 * int(hit) >= int(n)):
            kept.add(row.doc_id)
    assert ids(after) == kept


def test_pii_stage_changes_only_texts_with_pii(stages):
    _, before, after = stages[3]
    want = {r.doc_id: r.pseudonymised for r in pii.pseudonymise(before).collect()}
    for r in after.collect():
        assert r.text == want[r.doc_id] and r.n_chars == len(r.text)
    assert ids(after) == ids(before)
    emails = {m for r in before.collect() for m in re.findall(r"[a-z0-9.]+@[a-z0-9.]+\w", r.text)}
    left = " ".join(r.text for r in after.collect())
    assert emails and not any(m in left for m in emails)


def test_pieces_stage_and_run(spark, stages):
    _, before, after = stages[4]
    assert ids(after) == ids(before) and after.where("not round_trip").count() == 0
    whole = cp.run(spark, SMALL)
    assert sorted(map(str, whole.collect())) == sorted(map(str, after.collect()))


def test_stages_on_odd_and_empty_tables(spark, odd):
    docs = odd
    for name, stage in cp.STAGES[:-1]:
        docs = cp.materialise(stage(spark, docs, SMALL), name)
        assert docs.columns == odd.columns
    out = cp.STAGES[-1][1](spark, docs, SMALL).collect()
    texts = sorted((str(r.doc_id), (r.text or "")[:10]) for r in out)
    # without a letter, without text, and repeated rows are gone; one of the near copies stays
    assert [t for t in texts if t[0] in ("1", "2", "3", "9", "5")] == []
    assert [t[0] for t in texts].count("4") == 1 and [t[0] for t in texts].count("None") == 1
    docs = odd.limit(0)
    for name, stage in cp.STAGES:
        docs = cp.materialise(stage(spark, docs, SMALL), name)
    assert docs.count() == 0


def test_one_row_of_each_group_stays_also_without_ids(spark):
    words = " ".join(f"w{i}" for i in range(200))
    rows = [(5, words, "x"), (5, words + " end", "x"), (5, words, "y"), (9, words + " tail", "x")]
    rows += [(None, words.upper().replace("W", "V"), "x"), (None, words.upper().replace("W", "V") + " more", "x")]
    rows += [(None, "something else altogether", "x"), (7, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = cp.one_of_each_group(spark, docs, "").collect()
    assert sorted(str(r.doc_id) for r in kept) == ["5", "7", "None", "None"]
