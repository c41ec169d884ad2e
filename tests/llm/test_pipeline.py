"""The pipeline's stages against brute force on what each one's predecessor kept."""

import collections
import random

import pytest

import corpus_pipeline as P
from parcelworks.llm import mixing, packing, toxicity
from parcelworks.llm.shingles import shingles_as_tuples

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def make_rows():
    rng = random.Random(8)
    common = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(common) for _ in range(rng.randint(20, 60))]
        bad = i % 5 == 0
        for _ in range(4 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["grumbly", "snarkest", "bogging"]))
        rows.append((i, " ".join(words), rng.choice(["en", "de", None]), rng.choice(["src0", "src1", None])))
        labels.append((i, int(bad)))
    base = [rng.choice(common) for _ in range(120)]
    for i in range(400, 420):  # near copies: one changed word among 120
        own = list(base)
        own[rng.randrange(120)] = f"own{i}"
        rows.append((i, " ".join(own), "en", "src1"))
    rows += [(i, rows[j][1].upper(), "de", "src0") for i, j in ((430, 1), (431, 1), (432, 401))]
    rows += [(440, None, None, None), (441, "", "en", "src0"), (442, "long " * 3000, "en", "src2")]
    return [(d, t, lang, s, len(t or "")) for d, t, lang, s in rows], labels


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, by name; first the documents."""
    folder = tmp_path_factory.mktemp("tables")
    rows, labels = make_rows()
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {"documents": docs}
    for name, stage in P.STAGES:
        out = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, str(folder)).write.parquet(out)
        docs = spark.read.parquet(out)
        found[name] = docs
    return found


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stages_keep_the_columns(stages):
    assert [name for name, _ in P.STAGES] == list(stages)[1:]
    for name in list(stages)[1:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_toxic_documents_go_and_clean_ones_stay(stages):
    labels = dict(make_rows()[1])
    kept = set(texts(stages["toxicity"]))
    toxic = {d for d, bad in labels.items() if bad}
    every = set(texts(stages["documents"]))
    assert len(toxic & kept) <= 0.05 * len(toxic)
    assert len((every - toxic) - kept) <= 0.02 * len(every)


def test_one_of_equal_texts_stays(stages):
    largest = {}
    for d, t in texts(stages["toxicity"]).items():
        key = (t or "").lower()
        largest[key] = max(d, largest.get(key, d))
    assert set(texts(stages["exact_dedup"])) == set(largest.values())


def test_one_of_near_copies_stays(stages):
    before = texts(stages["exact_dedup"])
    sets = {d: shingles_as_tuples(t, 5) for d, t in before.items()}
    least = {d: d for d in before}
    changed = True
    links = [(a, b) for a in before for b in before if a < b and sets[a] & sets[b]]
    links = [(a, b) for a, b in links if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    assert links
    assert set(texts(stages["ngram_jaccard_join"])) == set(least.values())


def test_mixing_takes_whole_epochs_then_a_prefix(spark, stages):
    before = texts(stages["ngram_jaccard_join"])
    taken = collections.Counter(r.doc_id for r in stages["source_mixing"].collect())
    assert set(taken) <= set(before) and max(taken.values()) <= mixing.EPOCHS
    size = {d: len((t or "").split()) for d, t in before.items()}
    total = sum(size.values())
    used = sum(size[d] * n for d, n in taken.items())
    assert 0 < used <= mixing.SHARE * total


def test_packing_holds_every_document(stages):
    from tokenizers import Tokenizer

    public = pytest.importorskip("public_tokenizers")
    own = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    want, got, used = collections.Counter(), collections.Counter(), collections.defaultdict(list)
    for r in stages["source_mixing"].collect():
        want[r.doc_id] += len(own.encode(r.text or "", add_special_tokens=False).ids) + 1
    for r in stages["best_fit_packing"].collect():
        got[r.doc_id] += r.length
        used[r.sequence_id].append((r.offset, r.length))
    assert want == got
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_scores_never_read_the_language(spark, stages):
    """The language only chooses the threshold."""
    rows, labels = make_rows()
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.fit_on(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    one = {r.doc_id: r._score for r in toxicity.score(docs, model).collect()}
    two = {r.doc_id: r._score for r in toxicity.score(docs.selectExpr("doc_id", "text", "'xx' as lang", "source"), model).collect()}
    assert one == two
