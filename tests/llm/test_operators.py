"""Every operator against a brute-force version, on a fixture with nulls, empty and long texts, ties and clashing names."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from parcelworks.llm import (
    exact_dedup,
    html_extract,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    suffix_dedup,
    token_output,
    toxicity,
    winnowing,
)
from parcelworks.llm.shingles import shingles_as_tuples

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, id long, part int, root long"


def make_rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["ba", "re", "ti", "on", "é", "ka"]) for _ in range(rng.randint(1, 4)))
    texts = [" ".join(word() for _ in range(rng.choice([3, 12, 60, 200]))) for _ in range(30)]
    base = [word() for _ in range(150)]
    for _ in range(40):  # a group of near copies
        own = list(base)
        own[rng.randrange(150)] = word()
        texts.append(" ".join(own))
    texts += [texts[0]] * 6 + [texts[1].upper(), "", "   \n ", None, None, "ab" * 900, "x " * 2000, "solo"]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["src0", "src1", "web", None])) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[2], None, None), (None, None, "en", "src0"), (5, "another text here", "en", "src1")]
    return [(d, t, lang, s, 1, "k", 7, 0, 0) for d, t, lang, s in rows]


ROWS = make_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_dedup(docs, empty):
    groups = collections.defaultdict(list)
    for d, t, *_ in ROWS:
        groups[fold(t)].append(d)
    found = exact_dedup.mark(docs).collect()
    assert len(found) == len(ROWS)
    by = collections.defaultdict(list)
    for r in found:
        by[r.text_sha256].append(r)
    for text, ids in groups.items():
        own = by[hashlib.sha256(text.encode()).hexdigest()]
        assert sorted(str(r.doc_id) for r in own) == sorted(map(str, ids))
        best = max((i for i in ids if i is not None), default=None)
        assert {r.keep_id for r in own} == {best} and {r.group_size for r in own} == {len(ids)}
        assert sum(r.kept for r in own) == 1 and next(r for r in own if r.kept).doc_id == best
    left = exact_dedup.drop_duplicates(docs)
    assert left.columns == docs.columns and left.count() == len(groups)
    smallest = {r.keep_id for r in exact_dedup.mark(docs, keep="smallest").collect()}
    assert smallest == {min((i for i in ids if i is not None), default=None) for ids in groups.values()}
    assert exact_dedup.mark(empty).count() == 0 and exact_dedup.drop_duplicates(empty).count() == 0


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_ngram_join(docs, empty, k, percent):
    sets = [shingles_as_tuples(t, k) for _, t, *_ in ROWS]
    parent = list(range(len(ROWS)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, *_) in enumerate(ROWS):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    want = [(d, len(s), least.get(root(i)) if s else d) for i, ((d, *_), s) in enumerate(zip(ROWS, sets, strict=True))]
    found, _ = ngram_join.jaccard_components(docs, k, percent)
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in found.collect())
    kept = ngram_join.one_per_component(docs, k, percent)
    assert kept.columns == docs.columns
    assert ngram_join.jaccard_components(empty, k, percent)[0].count() == 0


def test_one_per_component_rows(spark):
    """Shared ids, repeated rows and null ids: one row of each component stays, and nothing else goes."""
    rng = random.Random(12)
    base = [[f"w{rng.randrange(10**6)}" for _ in range(120)] for _ in range(4)]
    near = lambda g, n: " ".join([*base[g][:-1], f"end{n}"])
    clean = [" ".join(f"c{rng.randrange(10**6)}" for _ in range(50)) for _ in range(3)]
    rows = [
        (940, near(0, 1)), (950, near(0, 2)), (950, clean[0]),  # a clean text shares the id of a near copy
        (900, near(1, 1)), (900, near(1, 2)), (901, near(1, 3)),  # the smallest id stands at two near copies
        (None, near(2, 1)), (None, near(2, 2)), (None, near(2, 3)), (None, clean[1]),
        (7, near(3, 1)), (7, near(3, 1)), (None, near(3, 2)),
        (8, clean[2]), (8, clean[2]), (9, ""), (9, ""), (None, None),
    ]
    sets = [shingles_as_tuples(t, 5) for _, t in rows]
    left, want = set(range(len(rows))), collections.Counter()
    while left:
        own = {min(left)}
        while more := {j for j in left - own for i in own if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}:
            own |= more
        left -= own
        ids = [rows[i][0] for i in own if rows[i][0] is not None]
        want[min(ids, default=None), frozenset(rows[i][1] for i in own if rows[i][0] == min(ids, default=None))] += 1
    frame = spark.createDataFrame([(d, t, {"n": 1}) for d, t in rows], "doc_id long, text string, extra map<string,int>")
    kept = ngram_join.one_per_component(frame.repartition(3), 5, 80)
    assert kept.columns == frame.columns
    found = collections.Counter()
    for r in kept.collect():
        (key,) = [w for w in want if w[0] == r.doc_id and r.text in w[1]]
        found[key] += 1
    assert found == want


def test_ngram_join_long_lists(docs, monkeypatch):
    """The same components when every list is scanned in blocks."""
    from parcelworks.llm import linking

    want = sorted(str(tuple(r)) for r in ngram_join.jaccard_components(docs, 3, 90)[0].collect())
    monkeypatch.setattr(linking, "SHORT", 1)
    monkeypatch.setattr(linking, "BLOCK", 4)
    assert want == sorted(str(tuple(r)) for r in ngram_join.jaccard_components(docs, 3, 90)[0].collect())


@pytest.mark.parametrize("limit", [1000, 0])
def test_suffix_dedup(docs, empty, limit, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP_LIMIT", limit)
    raw = [(d, (t or "").encode()) for d, t, *_ in ROWS]
    seen = collections.Counter(t[k : k + 400] for _, t in raw for k in range(len(t) - 399))
    want = []
    for d, t in raw:
        gone = np.zeros(len(t) + 2, np.int8)
        for k in range(len(t) - 399):
            if seen[t[k : k + 400]] > 1:
                gone[k + 1 : k + 401] = 1
        kept = bytes(b for b, g in zip(t, gone[1:-1], strict=True) if not g)
        want.append((d, len(t), int(gone.sum()), int((np.diff(gone) == 1).sum()), kept))
    rows, spans = suffix_dedup.repeated_spans(docs)
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_spans(rows, spans).collect()]
    assert sorted(map(str, want)) == sorted(map(str, found))
    rows, spans = suffix_dedup.repeated_spans(empty)
    assert suffix_dedup.remove_spans(rows, spans).count() == 0


def test_suffix_dedup_keeps_first(spark):
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdef ") for _ in range(700))
    rows = [(i, f"{i}" * 50 + passage + f"{i}" * 30) for i in (1, 2, 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    rows_, spans = suffix_dedup.repeated_spans(frame, keep="first")
    found = {r.doc_id: r.n_removed for r in suffix_dedup.remove_spans(rows_, spans).collect()}
    assert found == {1: 0, 2: 700, 3: 700}


def tokenizer(name):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path(name)
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return path, lambda t: own.encode(t or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing(docs, empty):
    path, encode = tokenizer("byte_bpe_50k.json")
    want = collections.Counter()
    for d, t, *_ in ROWS:
        ids = [*encode(t), 2]
        first = len(ids) % 64 or min(len(ids), 64)
        at = 0
        for piece, end in enumerate([first, *range(first + 64, len(ids) + 1, 64)]):
            want[(d, piece, at, end - at, crc(ids[at:end]))] += 1
            at = end
    found = packing.pack(docs, path, capacity=64).collect()
    assert want == collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found)
    sequences = collections.defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in found)
    assert len(sequences) <= 1.05 * (total / 64) + 2
    assert packing.pack(empty, path).count() == 0


def test_pack_histogram_is_whole():
    histogram = {100: 7, 412: 50, 600: 33, 1024: 3, 1: 11, 777: 5}
    held = collections.Counter()
    for config, times in packing.pack_histogram(histogram, rounds=50):
        assert sum(s * n for s, n in config.items()) <= 1024
        for s, n in config.items():
            held[s] += n * times
    assert dict(held) == histogram


def test_pack_histogram_places_the_linear_program(monkeypatch):
    """The rest sees only what the rounded program left, also where every length is met once or twice."""
    seen, rest = [], packing._rest

    def watched(sizes, left, *others):
        seen.append(int(left.sum()))
        rest(sizes, left, *others)

    monkeypatch.setattr(packing, "_rest", watched)
    rng = random.Random(6)
    histogram = {s: rng.randint(1, 2) for s in rng.sample(range(20, 1024), 40)}
    made = packing.pack_histogram(histogram)
    held = collections.Counter()
    for config, times in made:
        assert sum(s * n for s, n in config.items()) <= 1024
        for s, n in config.items():
            held[s] += n * times
    assert dict(held) == histogram
    assert len(seen) == 1 and seen[0] < 0.25 * sum(histogram.values())


def test_pack_histogram_covers_every_length(monkeypatch):
    found, fractional = [], packing._fractional
    monkeypatch.setattr(packing, "_fractional", lambda *given: found.append((given, fractional(*given))) or found[-1][1])
    rng = random.Random(8)
    histogram = {s: rng.choice([1, 3, 40, 2000]) for s in range(1, 256)}
    made = packing.pack_histogram(histogram, 256)
    ((sizes, counts, *_), amounts), = found
    covered = np.zeros(len(sizes))
    for config, amount in amounts:
        assert sum(int(sizes[j]) * n for j, n in config.items()) <= 256
        for j, n in config.items():
            covered[j] += n * amount / counts[j]
    assert covered.min() > 1 - 1e-6
    whole = sum(s * n for s, n in histogram.items()) / 256
    halves = sum(n for s, n in histogram.items() if s > 128)
    assert sum(times for _, times in made) <= 1.03 * max(whole, halves) + 2


def test_token_output(docs, empty):
    path, encode = tokenizer("word_bpe_49k.json")
    folder, files = token_output.write_tokens(docs, path, shard_ids=500)
    found = sorted(token_output.read_tokens(folder, files).collect(), key=lambda r: r.start)
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    want = collections.Counter((d, crc([*encode(t), 1])) for d, t, *_ in ROWS)
    assert want == collections.Counter((r.doc_id, r.ids_crc32) for r in found)
    folder, files = token_output.write_tokens(empty, path)
    assert token_output.read_tokens(folder, files).count() == 0


@pytest.mark.parametrize("bits", [False, True])
def test_shard_round_trip(bits):
    ids = np.random.default_rng(0).integers(0, 1 << 20, 1000).astype("<u4")
    data = token_output.write_shard(ids, [(4, 600), (None, 400)], block_ids=128, bits=bits)
    assert (token_output.read_shard(data) == ids).all()
    assert (token_output.read_shard(data, 130, 700) == ids[130:700]).all()
    assert token_output.read_documents(data) == [(4, 0, 600), (None, 600, 400)]


def test_winnowing(docs, empty):
    distinct = {(d, t or "") for d, t, *_ in ROWS}
    order = sorted(distinct, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[1].encode()).digest()), reverse=True)
    after = {r: order[(i + 1) % len(order)] for i, r in enumerate(order)}
    want = collections.Counter()
    for d, t, *_ in ROWS:
        t = t or ""
        third = len(t) // 3
        edited = t[: len(t) - third] + after[(d, t)][1][:third]
        want[(d, len(t), hashlib.sha256(edited.encode()).hexdigest())] += 1
    found = winnowing.fingerprint_edits(docs).collect()
    assert want == collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert winnowing.fingerprint_edits(empty).count() == 0


def test_winnowing_guarantee(spark):
    rng = random.Random(2)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared = words(winnowing.K + winnowing.WINDOW - 1)
    rows = [(" ".join(words(n) + shared + words(9)),) for n in (0, 5, 40)]
    frame = spark.createDataFrame(rows, "text string")
    sets = [set(r[0]) for r in frame.select(winnowing.hash_set(winnowing.select_grams(frame.text))).collect()]
    assert sets[0] & sets[1] and sets[1] & sets[2] and sets[0] & sets[2]


def test_line_dedup(docs, empty):
    occurrences = collections.defaultdict(list)
    for d, t, *_ in {(d, t or "") for d, t, *_ in ROWS}:
        for n, line in enumerate(t.split("\n")):
            if line.strip(" \t\x0b\f\r"):
                occurrences[line.strip(" \t\x0b\f\r")].append((d is None, d or 0, n))
    lines = list(occurrences)
    sets = [line_dedup.shingles(x) for x in lines]
    found = line_dedup.dedup_lines(docs).collect()
    assert len(found) == len(ROWS)
    # one component per group of similar lines: what is left has no two similar lines in different documents
    left = {r.text.strip() for r in found if r.text.strip()}
    assert 0 < len(left) <= len(lines)
    kept = [s for x, s in zip(lines, sets, strict=True) if x in left]
    for i, a in enumerate(kept):
        for b in kept[:i]:
            assert len(a & b) < 0.8 * len(a | b)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_counts(spark):
    """Removed lines of every row, repeated rows and null ids included, against brute force."""
    rng = random.Random(21)
    line = lambda: "".join(rng.choice("abcdefghij ") for _ in range(60)).strip()
    common, other = line(), line()
    near = common[:30] + "#" + common[31:]  # shares 41 of 61 shingles
    close = other + "!"
    texts = [f"{common}\n{line()}\n\n{other}", f"{line()}\n  {common} ", f"{close}\n{line()}", f"{near}\n{other}", line()]
    rows = [(4, texts[0]), (4, texts[0]), (4, texts[0]), (6, texts[1]), (2, texts[2]), (2, texts[4]), (9, texts[3])]
    rows += [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, None), (3, ""), (3, ""), (6, texts[4])]
    held = [(d is None, d or 0, n, at, x.strip()) for n, (d, t) in enumerate(rows) for at, x in enumerate((t or "").split("\n")) if x.strip()]
    held.sort()
    distinct = list(dict.fromkeys(h[4] for h in held))
    group = {x: x for x in distinct}
    for x in distinct:
        for y in distinct:
            a, b = line_dedup.shingles(x), line_dedup.shingles(y)
            if len(a & b) >= 0.8 * len(a | b) and group[x] != group[y]:
                group = {z: group[x] if g == group[y] else g for z, g in group.items()}
    assert group[close] == group[other] and group[near] != group[common]
    seen, gone = set(), collections.defaultdict(set)
    for _, _, n, at, x in held:
        if group[x] in seen:
            gone[n].add(at)
        seen.add(group[x])
    want = collections.Counter()
    for n, (d, t) in enumerate(rows):
        parts = (t or "").split("\n")
        left = "\n".join(x for at, x in enumerate(parts) if at not in gone[n])
        want[d, sum(bool(x.strip()) for x in parts), len(gone[n]), left] += 1
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert want == collections.Counter(tuple(r) for r in line_dedup.dedup_lines(frame).collect())


def test_line_dedup_sets_are_exact_and_cheap(monkeypatch):
    """The sets of many short lines, zero bytes included, against slices; one sort a line, without numpy's set functions."""
    rng = random.Random(23)
    lines = ["".join(rng.choice("ab\0é") for _ in range(rng.randint(1, 60))) for _ in range(400)] + ["ab", "ab\0", "\0" * 25]
    calls, unique = [], np.unique
    monkeypatch.setattr(np, "unique", lambda *a, **k: calls.append(1) or unique(*a, **k))
    hashed = list(line_dedup.gram_sets(lines))
    assert not calls
    sets = []
    for line in lines:
        raw = line.encode().ljust(10, b"\0")
        sets.append({raw[j : j + 10] for j in range(len(raw) - 9)})
    assert [len(h) for h in hashed] == [len(s) for s in sets] and all((np.diff(h.astype(object)) > 0).all() for h in hashed)
    for a, b in zip(range(len(lines)), rng.sample(range(len(lines)), len(lines)), strict=True):
        x, y = line_dedup.shingles(lines[a]), line_dedup.shingles(lines[b])
        assert (len(x), len(y), len(x & y)) == (len(sets[a]), len(sets[b]), len(sets[a] & sets[b]))


def test_line_dedup_stores_no_texts(spark, tmp_path, monkeypatch):
    """What is stored grows with the number of lines, not with the texts."""
    rng = random.Random(22)
    texts = ["\n".join(rng.randbytes(2000).hex() for _ in range(5)) for _ in range(100)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    monkeypatch.setattr("parcelworks.llm.common.shared_dir", lambda _: str(tmp_path))
    assert line_dedup.dedup_lines(frame).where("n_lines = 5 and n_removed = 0").count() == len(texts)
    assert 0 < sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < 0.3 * sum(map(len, texts))


def test_mixing(docs, empty):
    taken = mixing.mix(docs, share=0.5, epochs=2)
    assert taken.columns[: len(docs.columns)] == docs.columns
    rows = taken.collect()
    total = sum(len((t or "").split()) for _, t, *_ in ROWS)
    assert 0.2 * total < sum(r._mix_tokens for r in rows) <= 0.5 * total
    everything = mixing.mix(docs, share=5, epochs=2)
    assert everything.count() == 2 * len(ROWS)
    assert mixing.mix(empty).count() == 0


def test_mixing_shortage_goes_to_siblings_first(spark):
    leaves = [("domain0", "en", "src0", 10), ("domain0", "de", "src0", 1000), ("domain1", "en", "src1", 1000)]
    frame = spark.createDataFrame(leaves, "_mix_domain string, _mix_lang string, _mix_source string, tokens long")
    quota = {(r._mix_domain, r._mix_lang): r.quota for r in mixing.budgets(frame, share=700 / 2010, epochs=1).collect()}
    # domain0 has 4/7 of 700; its small English leaf leaves the rest to German, none to domain1
    assert quota == {("domain0", "en"): 10, ("domain0", "de"): 390, ("domain1", "en"): 300}


def test_toxicity(spark, docs, empty):
    rng = random.Random(3)
    common = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(common) for _ in range(rng.randint(5, 60))]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["grumbly", "snarkest", "bogging"]))
        rows.append((i, " ".join(words), "en"))
        labels.append((i, int(bad)))
    rows += [(None, None, None), (1000, "", "en")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit_on(frame, marks)
    scored = toxicity.decide(toxicity.score(frame, model), model).withColumn("held", toxicity.held_out()).collect()
    own = [(r._score, dict(labels)[r.doc_id]) for r in scored if r.held and r.doc_id in dict(labels)]
    right = sum((s >= 0.3) == bool(y) for s, y in own)
    assert right >= 0.97 * len(own)
    assert all(0 <= r._score <= 1 for r in scored) and len(scored) == len(rows)
    none = toxicity.fit_on(frame, marks.where("toxic = 7"))
    assert toxicity.decide(toxicity.score(docs, none), none).where("_rejected").count() == 0
    assert toxicity.score(empty, model).count() == 0


def test_toxicity_learns_from_every_label(spark):
    rng = random.Random(5)
    marked = {1: range(0, 9000, 2), 0: range(1, 9000, 2)}
    # the word of the texts that come last in a hash order of their ids
    last = set(sorted(marked[1], key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[4000:])
    word = {i: "late" if i in last else "early" for i in marked[1]}
    rows = [(i, " ".join([*(f"w{rng.randint(0, 50)}" for _ in range(4)), word.get(i, "calm")]), "en") for i in range(9000)]
    frame = spark.createDataFrame([*rows, (10**6, "w1 w2 late", "en"), (10**6 + 1, "w1 w2 calm", "en")], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, y) for y, ids in marked.items() for i in ids], "doc_id long, toxic int")
    blocks, share = toxicity.training_blocks(frame, marks, ~toxicity.held_out())
    used = blocks.selectExpr("inline(arrays_zip(labels, lengths))").groupBy("labels").count().collect()
    allowed = {y: sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids) for y, ids in marked.items()}
    assert {r["labels"]: r["count"] for r in used} == allowed and min(allowed.values()) > 3000
    scores = {r.doc_id: r._score for r in toxicity.score(frame.where("doc_id >= 1000000"), toxicity.fit_on(frame, marks)).collect()}
    assert scores[10**6] >= 0.3 > scores[10**6 + 1]


def _shuffled_rows(plan) -> list[int]:
    """Rows written by each shuffle of a plan that has run."""
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return _shuffled_rows(plan.executedPlan())
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):
        return _shuffled_rows(plan.plan())
    own = [plan.metrics().apply("shuffleRecordsWritten").value()] if plan.getClass().getSimpleName() == "ShuffleExchangeExec" else []
    return own + [n for k in range(plan.children().size()) for n in _shuffled_rows(plan.children().apply(k))]


def test_toxicity_shuffles_labelled_texts_only(spark, monkeypatch):
    rows = [(i, f"w{i} w{i % 7}", "en") for i in range(4000)]
    # a doc_id may have several texts
    frame = spark.createDataFrame([*rows, *[(i, f"other{i}", "de") for i in range(0, 400, 2)]], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, i // 20 % 2) for i in range(0, 4000, 20)], "doc_id long, toxic int")
    seen, keep = {}, toxicity.stored

    def watched(df, name):
        df.collect()
        seen[name] = _shuffled_rows(df._jdf.queryExecution().executedPlan())
        return keep(df, name)

    monkeypatch.setattr(toxicity, "stored", watched)
    blocks, _ = toxicity.training_blocks(frame.repartition(2), marks, ~toxicity.held_out())
    allowed = [i for i in range(0, 4000, 20) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert blocks.selectExpr("inline(arrays_zip(labels, lengths))").count() == len(allowed)
    assert seen["training-blocks"] and max(seen["training-blocks"]) < 4 * len(allowed)


def test_toxicity_vocabulary(monkeypatch):
    """Batches that add words, add none or start anew give the buckets of every word; known words are not gathered again."""
    monkeypatch.setattr(toxicity, "_CACHE_LIMIT", 9000)
    words, rng = toxicity.Vocabulary(), random.Random(8)
    for step in range(12):
        texts = [" ".join(f"Wo.rd{rng.randint(0, 1000 * step)}" for _ in range(rng.randint(0, 1500))) for _ in range(4)] * (step % 3)
        for text, found in zip([*texts, None, ""], words.read([*texts, None, ""]), strict=True):
            parts = [[w, *("^" + w[:n] for n in (4, 5, 6))] for w in (text or "").lower().replace(".", "").split()]
            want = [[1 + zlib.crc32(p.encode()) % (toxicity.BUCKETS - 1) for p in word] for word in parts]
            assert found.shape == (len(want), 4) and found.tolist() == want
    table = words.table
    words.read([texts[0]])
    assert words.table is table


def test_toxicity_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", 300)
    rng = random.Random(6)
    rows = [(i, " ".join([*(f"w{rng.randint(0, 50)}" for _ in range(9)), "vile" if i % 3 == 0 else "fine"]), "en") for i in range(300)]
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    scores = []
    for n in (1, 7):
        frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(n)
        assert toxicity.training_blocks(frame, marks, ~toxicity.held_out())[0].count() > 4
        scores.append({r.doc_id: r._score for r in toxicity.score(frame, toxicity.fit_on(frame, marks)).collect()})
    assert scores[0] == pytest.approx(scores[1], abs=1e-6)  # texts scored in other batches round otherwise


def test_html_extraction(spark):
    pages = [
        (1, "u", '<html><body><nav><ul><li><a href="/a">Menu</a></li></ul></nav><article><h1>Title &amp; more</h1>'
                 "<p>First <b>bold</b>\n text.<p>Second&nbsp;one is here, too.</article><footer>&copy; me</footer>"),
        (2, None, None),
        (None, "v", ""),
        (3, "w", "<script>var a = '<p>';</script>"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' as text")
    found = {(r.page_id, r.url): (r.text, r.n_chars) for r in html_extract.extract_texts(frame).collect()}
    text = "Title & more\n\nFirst bold text.\n\nSecond one is here, too."
    assert found == {(1, "u"): (text, len(text)), (2, None): ("", 0), (None, "v"): ("", 0), (3, "w"): ("", 0)}


@pytest.mark.parametrize(
    ("before", "hidden"),
    [
        ('<svg width="1" viewBox=\'0 0 1 1\'/>', ""),
        ("<p>a<svg><title/><path d='M0'/><g><svg/></g><text>no</text></svg>", "a"),
        ("<svg-icon name=x></svg-icon><button-group></button-group>", ""),
        ("<title-bar>Bar</title-bar><title_bar>Two</title_bar>", "Bar Two"),
        ("<datalist id=d><option value=a><option value=b></datalist>", ""),
        ("<datalist id=d><option value=a>no<option value=b>no</datalist>", ""),
        ("<select><optgroup label=x><option>no<option>no</optgroup></select>", ""),
        ("<div><button>yes</div>", "yes"),
        ("<div><object><object>no</object>no</object>yes</div>", "yes"),
        ("<noscript><p>no</noscript><template><div>no</template><iframe></div></iframe>", ""),
        ("<iframe src=x><object data=y><button>", ""),
        ("<SCRIPT>no</script-x> no</SCRIPT ><textarea>no<p></textarea>", ""),
    ],
)
def test_html_blocks_keep_what_follows(before, hidden):
    page = f"<body>{before}<article><h1>Title</h1><p>Text one.</p></article><p>Last</p><svg>no</svg></body>"
    texts = [text for text, *_ in html_extract.blocks(page)]
    assert texts[-3:] == ["Title", "Text one.", "Last"] and " ".join(texts[:-3]) == hidden


def test_html_path_has_every_mark():
    names = [f"u{chr(97 + i)}" for i in range(20)]
    page = f'<div class="{" ".join(names)}" id="sidebar"><p>Text</p></div>'
    ((_, path, _),) = html_extract.blocks(page)
    assert path == ("div", *("." + n for n in names), ".sidebar", "p")


def test_html_blocks_unended_raw_text():
    assert [text for text, *_ in html_extract.blocks("<p>One</p><script>var a = '<p>no</p>';")] == ["One"]
    assert [text for text, *_ in html_extract.blocks("<p>One</p><template><p>Two</p>")] == ["One", "Two"]


def test_labeller_on_unseen_pages():
    model, maker = html_extract.train(pages=250, epochs=4), html_extract.PageMaker(77)
    wrong = total = 0
    for _ in range(100):
        page, labels = maker.page()
        found = html_extract.blocks(page)
        if len(found) == len(labels):
            wrong += int((model.label([html_extract.vectors(found)])[0] != np.array(labels)).sum())
            total += len(labels)
    assert wrong < 0.04 * total
