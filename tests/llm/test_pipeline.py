"""The corpus pipeline on planted documents: every stage against a plain model of it, and run() against the stages."""

import collections
import random
import re

import pytest

import corpus_pipeline
from tests.llm.test_native import taken_by_hand

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SECRET = "hunter2hunter2hunter2"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    folder = str(tmp_path_factory.mktemp("corpus"))
    passages = [" ".join(words(rng, 14)) for _ in range(4)]
    texts, toxic = {}, set()
    for i in range(420):
        body = words(rng, rng.randint(30, 90))
        if i % 6 == 0:
            body[rng.randrange(len(body))] = rng.choice(["Scumword", "trashword"])
            toxic.add(i)
        elif i % 29 == 1:
            body.insert(rng.randrange(len(body)), passages[i % 4])
        elif i % 31 == 2:
            body.insert(rng.randrange(len(body)), f"password = {SECRET}")
        texts[i] = " ".join(body)
    for k, i in enumerate(range(7, 300, 17)):  # exact and near copies, some of toxic or contaminated ones; chains of changes too
        texts[1000 + k] = texts[i]
        texts[2000 + k] = texts[i] + " tail"
        texts[3000 + k] = texts[i] + " tail of more"
        toxic |= {x + k for x in (1000, 2000, 3000)} if i in toxic else set()
    rows = [(i, t, "en", rng.choice(["a", "a", "a", "b", "c", None]), len(t)) for i, t in texts.items()]
    rows += [(5000, None, None, "b", 0), (5001, "", "en", None, 0), rows[5], rows[5]]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(300)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(f"q{i}", p) for i, p in enumerate(passages)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, toxic, passages


def kept_of_groups(rows):
    """Of rows as (id, text) one for each component of similar five-word shingle sets."""
    rows = sorted(set(rows), key=str)
    sets = []
    for _, text in rows:
        found = [w.lower() for w in WORD.findall(text or "")]
        sets.append({tuple(found[i : i + 5]) for i in range(len(found) - 4)} or ({tuple(found)} if found else set()))
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    best = {}
    for i, row in enumerate(rows):
        best[top(i)] = min(best.get(top(i), row), row, key=lambda r: r[0])
    return sorted(best.values(), key=str)


def contaminated(text, passages):
    def grams(t):
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
        return {tuple(found[i : i + 10]) for i in range(len(found) - 9)}

    return bool(grams(text) & set().union(*map(grams, passages)))


def test_stages_against_plain_models_and_run(spark, corpus):
    folder, toxic, passages = corpus
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "mix"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    states = [docs.collect()]
    for name, fn in corpus_pipeline.STAGES[:-1]:
        docs = fn(spark, docs, folder)
        assert docs.columns == COLUMNS, name
        states.append(docs.collect())
        docs = spark.createDataFrame(states[-1], docs.schema)

    def pairs(rows):
        return sorted(((r["doc_id"], r["text"]) for r in rows), key=str)

    start, clean, single, safe, redacted = map(pairs, states)
    assert clean == [p for p in start if p[0] not in toxic]
    assert single == kept_of_groups(clean)
    assert safe == [p for p in single if not contaminated(p[1], passages)]
    assert 0 < len(safe) < len(single) < len(clean) < len(start)
    assert [i for i, _ in redacted] == [i for i, _ in safe]
    for (_, before), (_, after) in zip(safe, redacted):
        assert after == before if SECRET not in (before or "") else SECRET not in after and after.split(" ")[0] == before.split(" ")[0]
    assert sum(SECRET in (t or "") for _, t in safe) > 3
    assert all(r["n_chars"] == len(r["text"]) for r in states[-1] if r["text"] is not None)

    mixed = corpus_pipeline.run(spark, folder).collect()
    want = collections.Counter()
    sizes = [(r["doc_id"], r["source"], len(WORD.findall(r["text"] or ""))) for r in states[-1]]
    for i, n, taken in taken_by_hand(sizes):
        want[i] += taken // n if n else 0
    got = collections.Counter(r["doc_id"] for r in mixed)
    assert {k: v for k, v in got.items() if k < 5000} == {k: v for k, v in want.items() if v}
    assert {(r["doc_id"], r["text"]) for r in mixed} <= set(redacted)
