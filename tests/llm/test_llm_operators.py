"""The training-data operators against brute force, and their edge cases."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (
    decontamination, fingerprints, html_text, licenses, line_dedup, mixing, near_dups, token_counts, toxicity,
    url_filters, words as W,
)
from tidemark.llm.graph import Steps, components
from tidemark.llm.shipping import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def prose(rng, n):
    return " ".join(rng.choice(["The", "sea", "is", "wide,", "und", "übrig", "l'été", "42", "x-ray", "a\nb"])
                    + rng.choice(["", "s", "ing", "er"]) for _ in range(n))


def sample(n=40, seed=3):
    """Documents with copies, near copies, nulls, empty and long texts, repeated rows and clashing ids."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randint(1, 120)), "en", f"src{i % 3}", 0) for i in range(n)]
    rows += [(n + i, rows[i][1], "en", "src0", 0) for i in range(4)]
    rows += [(n + 10 + i, rows[i + 5][1] + " tail", "en", "src0", 0) for i in range(4)]
    rows += [(100, None, None, None, None), (101, "", "en", "src1", 0), (102, "!!! ???", "en", None, 7),
             (103, prose(rng, 20_000), "en", "src2", 0), (None, "no id here at all", "en", "src1", 0),
             rows[1], rows[1], (1, "another text under a used id", "en", "src9", 0), (104, "  \n\n ", "en", "", 0)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.createDataFrame(sample(), DOCS).repartition(3, "doc_id").cache()


@pytest.fixture(scope="module")
def empty(spark):
    ship(spark)
    return spark.createDataFrame([], DOCS)


def test_words_and_windows():
    texts = [None, "", "Ab cD-3 é!x", "--", "one two three four five six"]
    found = W.Words(pa.array(texts))
    assert found.counts.tolist() == [len(words_of(t)) for t in texts]
    spelled = [bytes(W.LOWER[found.raw[a:b]]).decode() for a, b in zip(found.starts, found.ends)]
    assert spelled == [w for t in texts for w in words_of(t)]
    places, _ = W.windows(found.hashes(), found.first, 5)
    assert places.tolist() == [0, 5, 6]
    rows, _ = W.shingles(found.hashes(), found.first, 5)
    assert sorted(rows.tolist()) == [2, 4, 4]


def toxic_documents(n=240):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = prose(rng, 40) + (f" vile{rng.choice(['', 'ly', 'ness', 'r', 'st'])}" * 4 if toxic else "")
        rows.append((i, text, "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_labels(spark):
    rows, labels = toxic_documents()
    labels += [(None, 1, 1), (3, 1, None), (5, 0, 0)]
    frame = spark.createDataFrame(rows + [(900, None, None, None, None), (901, "", "", "", 0)], DOCS)
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = {r["doc_id"]: r for r in toxicity.scores(frame, model).withColumn("r", toxicity.remainder()).collect()}
    held = [i for i in range(240) if found[i]["r"] == 2]
    right = sum((found[i]["score"] >= toxicity.THRESHOLD) == (i % 4 == 0) for i in held)
    assert right >= 0.95 * len(held)
    assert found[900]["score"] == found[901]["score"] < toxicity.THRESHOLD
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_toxicity_without_labels_or_rows(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.scores(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    assert toxicity.scores(empty, toxicity.fit(empty, none)).count() == 0


def kneser_ney(counts):
    """Own part and backoff weight by context and letter, for counts of runs as bytes."""
    total, kinds = collections.Counter(), collections.Counter()
    for run, n in counts.items():
        total[run[:-1]] += n
        kinds[run[:-1]] += 1

    def share(run):
        if not total[run[:-1]]:
            return 0.0, 1.0
        return (max(counts[run] - toxicity.DISCOUNT, 0) / total[run[:-1]],
                toxicity.DISCOUNT * kinds[run[:-1]] / total[run[:-1]])
    return share


def letter_runs(word):
    letters = bytes(toxicity.ORDER) + word.encode() + b"\0"
    return [letters[i - 7:i + 1] for i in range(toxicity.ORDER, len(letters))]


def brute_ratio(texts, by_class):
    """The log ratio of a word, with counts over all words of texts and of the texts of each class."""
    longer = {r[-7:] for t in texts for w in words_of(t) for r in letter_runs(w)}
    shared = {}
    for order in range(toxicity.SHARED, 0, -1):
        shared[order] = kneser_ney(collections.Counter(r[1:] for r in longer))
        longer = {r[1:] for r in longer}
    classes = []
    for own in by_class:
        top = collections.Counter(r for t in own for w in words_of(t) for r in letter_runs(w))
        classes.append((kneser_ney(collections.Counter(r[1:] for r in top)), kneser_ney(top)))

    def ratio(word):
        total = 0.0
        for run in letter_runs(word):
            rest = 1 / 256
            for order in range(1, toxicity.SHARED + 1):
                own, weight = shared[order](run[-order:])
                rest = own + weight * rest
            chances = []
            for low, top in classes:
                own, weight = low(run[1:])
                chance = own + weight * rest
                own, weight = top(run)
                chances.append(own + weight * chance)
            total += np.log(chances[1] / chances[0])
        return total
    return ratio


def test_kneser_ney_sums_to_one():
    runs = np.unique(W.mix(np.arange(1, 50, dtype=np.uint64)) & np.uint64(0xFFFF))
    own, weight = toxicity._share(runs, np.full(len(runs), 3.0))
    for context in np.unique(runs >> np.uint64(8)):
        some = runs >> np.uint64(8) == context
        assert own[some].sum() + weight[some][0] == pytest.approx(1)


@pytest.mark.parametrize("buckets", [1, 97])
def test_toxicity_counts_are_whole(spark, monkeypatch, buckets):
    """Every run of the classes keeps its count: ratios of words equal those of a plain model over all runs."""
    monkeypatch.setattr(toxicity, "LEAST_BUCKETS", buckets)
    rows, labels = toxic_documents(80)
    rows.append((82, "onceonlyvile", "en", "s", 0))  # one toxic run among more frequent ones
    rows += [rows[4], (4, "a second text of an id, é", "", "", 0), (None, "no id", "", "", 0), (90, None, "", "", 0)]
    labels.append((82, 1, 1))
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame, marked)
    part = {r["doc_id"]: r["r"] for r in marked.select("doc_id", toxicity.remainder().alias("r")).collect()}
    toxic = {doc: t for doc, _, t in labels}
    words = sorted({w for r in rows for w in words_of(r[1])})
    found = W.Words(pa.array(words))
    for kind, out in (("fitted", (2, 3)), ("whole", (2,))):
        ratio = brute_ratio([r[1] for r in rows], [[r[1] for r in rows if toxic.get(r[0]) == c and part[r[0]] not in out]
                                                   for c in (0, 1)])
        want = [ratio(w) for w in words]
        packed = model.ratios.runs.collect()
        runs = np.concatenate([np.frombuffer(r["runs"], np.uint64) for r in packed])
        each, order = np.concatenate([np.frombuffer(r[kind], np.float32) for r in packed]), np.argsort(runs)
        runs = runs[order], each[order]
        assert toxicity.by_runs(found, *runs) == pytest.approx(want, abs=1e-4)
        by_hash = {r["word"]: r["ratio"] for r in model.ratios.word_ratios(Steps(spark, "test"), frame, kind).collect()}
        hashes = found.hashes().view(np.int64).tolist()
        assert [by_hash.get(h, 0.0) for h in hashes] == pytest.approx(want, abs=1e-4)
    sent = {r["doc_id"]: r["score"] for r in toxicity.scores(frame, model).collect()}
    assert {r["doc_id"]: r["score"] for r in toxicity.scores(frame, model, sent=0).collect()} == pytest.approx(sent)


def test_toxicity_with_clashing_columns(spark):
    rows, labels = toxic_documents(80)
    frame = spark.createDataFrame([(*r[:2], 1, "x", 2, 0.5) for r in rows],
                                  "doc_id long, text string, part int, run string, toxic int, score double")
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    for sent in (None, 0):
        found = toxicity.scores(frame, model, sent)
        assert set(found.columns) == set(frame.columns) and found.where("run = 'x' and part = 1").count() == 80


def brute_hits(text, items, window):
    found, hit, ids = words_of(text), set(), set()
    for item, item_text in items:
        w = words_of(item_text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            for j in range(len(found) - size + 1):
                if found[j:j + size] == w[i:i + size]:
                    hit |= set(range(j, j + size))
                    ids |= {str(item)} if item is not None else set()
    return len(found), len(hit), sorted(ids)


@pytest.mark.parametrize("block_words", [decontamination.BLOCK_WORDS, 40])
def test_decontamination(spark, empty, block_words):
    rng = random.Random(9)
    items = [(i, " ".join(rng.choice("abcd") for _ in range(rng.choice([0, 2, 5, 14, 25])))) for i in range(12)]
    items += [(3, items[3][1]), (50, None), (None, "lone item"), (51, "a b a b a b a b a b a b")]
    rows = [(i, " ".join(rng.choice("abcdxy") for _ in range(60)) + " " + (items[i % 12][1] or ""), "", "", 0)
            for i in range(30)] + [(100, None, "", "", 0), (101, "", "", "", 0), (102, "the Lone; item!", "", "", 0)]
    frame = spark.createDataFrame(rows, DOCS)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontamination.digest(
        decontamination.matches(frame, table, block_words=block_words)).collect()}
    for doc, text, *_ in rows:
        n, hit, ids = brute_hits(text, items, 10)
        assert (got[doc]["n_words"], got[doc]["n_hit"], got[doc]["n_items"]) == (n, hit, len(ids))
        assert got[doc]["items_sha256"] == hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert got[doc]["contaminated"] == (hit > 0)
    assert decontamination.matches(empty, table).count() == 0
    nothing = decontamination.matches(frame, table.limit(0)).collect()
    assert len(nothing) == len(rows) and not any(r["spans"] for r in nothing)


def test_removed_spans(spark):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"Before it: {item.upper()}. And after, much more text than that stands here to stay, yes.", "a", "b", 5),
            (2, item, "a", "b", 5), (3, "clean", "a", "b", 5), (4, None, "a", "b", None)]
    frame = spark.createDataFrame(rows, DOCS).withColumn("spans", F.lit(1)).withColumn("n_words", F.lit(2))
    got = {r["doc_id"]: r for r in decontamination.remove_spans(
        frame, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert set(got) == {1, 3, 4}
    assert got[1]["text"] == "Before it: . And after, much more text than that stands here to stay, yes."
    assert got[1]["n_chars"] == len(got[1]["text"]) and (got[3]["text"], got[3]["n_chars"]) == ("clean", 5)
    assert got[1]["spans"] == 1 and got[1]["n_words"] == 2


def test_spans_are_found_and_removed_by_one_worker_a_task(spark):
    """The plan passes documents to Python once; several blocks of items leave the same texts as one."""
    items = [(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(6)]
    rows = [(i, f"Kept {i}: {items[i % 6][1]}; and {items[(i + 1) % 6][1]} " + "more words here " * 20, "a", "b", 5)
            for i in range(12)]
    frame = spark.createDataFrame(rows, DOCS)
    table = spark.createDataFrame(items, "item_id long, text string")
    clean = decontamination.remove_spans(frame, table)
    assert clean._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    got = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert got == {i: f"Kept {i}: ; and  {'more words here ' * 20}".strip() for i in range(12)}
    blocks = decontamination.matches(frame, table, block_words=20, finish=decontamination._cleaning(1)).collect()
    assert {r["doc_id"]: r["text"] for r in blocks} == got
    short = decontamination.remove_spans(frame, table, min_words=13).collect()
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in short} == {r[0]: (r[1], 5) for r in rows}


def test_token_counts(spark, docs, empty):
    count = token_counts.counter("byte_bpe_50k.json")
    small = token_counts.counter("byte_bpe_50k.json", 200, 8)
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "1", "'s", "<|endoftext|>", "<|endof", "!", "...", "字", "　",
             "\r\n", "😀", "x y", "​", "᠎", " hello", "word."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 400))) for _ in range(400)]
    texts += ["a" * 3000, "字" * 900, " " * 2000 + "x", "ab " * 2000, "\n" * 700 + "a" + " \n" * 300]
    want = [len(e) for e in count.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert count.counts(texts) == want
    assert small.counts(texts) == want
    rows = token_counts.token_counts(docs).collect()
    assert len(rows) == docs.count()
    assert {(r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows if r["doc_id"] in (100, 101)} == {(0, 0, False)}
    assert token_counts.token_counts(empty).count() == 0


def test_fingerprints_of_text_ids_and_hot_ids(spark):
    rows = [(f"d{i:03d}", prose(random.Random(i), 12), 1) for i in range(30)] + [("d007", "again", 2)] * 20
    rows += [(None, prose(random.Random(i), 9), 3) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id string, text string, range int")
    source = frame.orderBy(F.desc_nulls_last("doc_id"), F.desc(F.xxhash64("text"))).collect()
    texts = [r["text"] for r in source]
    want = collections.Counter((r["doc_id"], hashlib.sha256(fingerprints.edited(
        t, texts[(i + 1) % len(texts)]).encode()).hexdigest()) for i, (r, t) in enumerate(zip(source, texts)))
    for ranges in (1, 9, 200):
        found = fingerprints.fingerprints(frame, ranges).collect()
        assert collections.Counter((r["doc_id"], r["edited_sha256"]) for r in found) == want


def test_run_counts_and_ratios_in_pieces(monkeypatch):
    """What a task passes on early, and what meets in pieces, adds up to the same ratios."""
    texts = [prose(random.Random(i), 60) for i in range(30)]
    batches = [pa.record_batch({"text": texts[i:i + 5], "part": pa.array([0, 1, 2, 3, None], pa.int32())})
               for i in range(0, 30, 5)]

    def ratios():
        table = pa.Table.from_batches(list(toxicity._run_counts(5)(iter(batches))))
        short = pa.Table.from_batches(list(toxicity._short_runs(iter(table.to_batches()))))
        low, n = np.unique(short.column("run").to_numpy().view(np.uint64) & np.uint64(0xFFFFFF), return_counts=True)
        sent = [type("Sent", (), {"value": v}) for v in (low, toxicity.lowest(low, n))]
        parts = table.sort_by("bucket").to_batches(max_chunksize=2)
        found = pa.Table.from_batches(list(toxicity._ratio_rows(*sent)(iter(parts)))).to_pylist()
        return len(table), {run: pair for r in found for run, *pair in zip(
            *(np.frombuffer(r[c], t).tolist() for c, t in (("runs", "u8"), ("fitted", "f4"), ("whole", "f4"))))}
    whole = ratios()
    monkeypatch.setattr(toxicity, "HELD_RUNS", 50)
    pieces = ratios()
    assert pieces[0] > whole[0] and pieces[1] == whole[1] and len(whole[1]) > 100


def test_short_runs_are_named_once_and_pieces_summed_as_they_come(monkeypatch):
    """Neither the short runs nor a bucket's sum works on all pieces anew or holds them all."""
    monkeypatch.setattr(toxicity, "HELD_RUNS", 200)
    texts = [prose(random.Random(i % 3), 40) for i in range(300)]
    batches = [pa.record_batch({"text": texts[i:i + 5], "part": pa.array([0] * 5, pa.int32())}) for i in range(0, 300, 5)]
    table = pa.Table.from_batches(list(toxicity._run_counts(2)(iter(batches))))
    short = pa.Table.from_batches(list(toxicity._short_runs(iter(table.select(["short"]).to_batches()))))
    want = {r[-toxicity.MEET - 1:] for t in texts for w in words_of(t) for r in letter_runs(w)}
    assert sorted(short.column("run").to_pylist()) == sorted(int.from_bytes(r, "big") for r in want)
    summed, sizes = toxicity._summed, []
    monkeypatch.setattr(toxicity, "_summed", lambda parts: sizes.append(sum(len(p[0]) for p in parts)) or summed(parts))
    low = np.unique(short.column("run").to_numpy().view(np.uint64) & np.uint64(0xFFFFFF))
    sent = [type("Sent", (), {"value": v}) for v in (low, np.ones(len(low)))]
    list(toxicity._ratio_rows(*sent)(iter(table.sort_by("bucket").to_batches(max_chunksize=3))))
    pieces = sum(len(toxicity._unpacked(c.as_py())) for c in table.column("runs"))
    assert len(table) > 50 and max(sizes) < pieces / 6


@pytest.mark.parametrize("ids", ["int", "string"])
def test_toxicity_of_more_runs_and_labels(spark, monkeypatch, ids):
    """Buckets of too many distinct runs are cut; labels of whole-number ids cost no join of the texts."""
    rows, labels = toxic_documents(80)
    frame = spark.createDataFrame(rows + [(None, "no id, but vileness", "", "", 0)], DOCS).repartition(3)
    frame = frame.withColumn("doc_id", F.col("doc_id").cast(ids))
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    marked = marked if ids == "int" else marked.withColumn("doc_id", F.col("doc_id").cast(ids))

    monkeypatch.setattr(toxicity, "LEAST_BUCKETS", 1)

    def found():
        model = toxicity.fit(frame, marked)
        return model.ratios.runs.count(), {r["doc_id"]: r["score"] for r in toxicity.scores(frame, model).collect()}
    whole = found()
    for name, value in (("SAMPLE", 1), ("BUCKET_RUNS", 50)):
        monkeypatch.setattr(toxicity, name, value)
    if ids == "int":
        monkeypatch.setattr(toxicity, "sent_if_small", None)
    cut = found()
    assert cut[0] > whole[0] == 1 and cut[1] == pytest.approx(whole[1], abs=1e-9) and None in cut[1]
    if ids == "int":
        monkeypatch.undo()
        monkeypatch.setattr(toxicity, "SENT_LABELS", 10)
        assert found()[1] == pytest.approx(whole[1], abs=1e-9)


def starting_shingles(text):
    w = words_of(text)
    return {tuple(w[max(0, i - 4):i + 1]) for i in range(len(w))}


@pytest.mark.parametrize("ranges", [1, 7])
def test_fingerprints(spark, docs, empty, ranges):
    rows = fingerprints.fingerprints(docs, ranges).collect()
    source = docs.orderBy(F.desc_nulls_last("doc_id"), F.desc(F.xxhash64(F.coalesce("text", F.lit(""))))).collect()
    assert len(rows) == len(source)
    texts = [r["text"] or "" for r in source]
    want = collections.Counter()
    for i, (r, t) in enumerate(zip(source, texts)):
        changed = fingerprints.edited(t, texts[(i + 1) % len(texts)])
        want[r["doc_id"], len(t), hashlib.sha256(changed.encode()).hexdigest()] += 1
    assert collections.Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == want
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["fingerprint"] == by_id[40]["fingerprint"]  # equal texts
    errors = []
    for i, (r, t) in enumerate(zip(source, texts)):
        a, b = starting_shingles(t), starting_shingles(fingerprints.edited(t, texts[(i + 1) % len(texts)]))
        if r["doc_id"] not in (1, None) and (a or b):
            errors.append(by_id[r["doc_id"]]["near_edited"] - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06
    assert fingerprints.fingerprints(empty).count() == 0


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(2)
    elements = rng.integers(1, 2**63, 60, dtype=np.uint64)
    a, b = rng.integers(1, 5, 60).astype(float), rng.integers(1, 5, 60).astype(float)
    b[::7] = 0.25
    owner = np.repeat([0, 1], 60)
    kept = near_dups.darts(np.r_[elements, elements], np.r_[a, b], owner, 2, 4096)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((kept[0] == kept[1]).mean() - want) < 0.03


def near_copies(n=60):
    """A chain of heavily and lightly edited copies, so that links and components differ."""
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(140)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 5, 8])):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 10**6)}"
        rows.append((200 + i, " ".join(w), "", "", 0))
    return rows


def brute_classes(rows):
    sets = []
    for doc, text, *_ in rows:
        w = words_of(text)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else {text or ""})
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return collections.Counter((r[0], least.get(root(i))) for i, r in enumerate(rows))


@pytest.mark.parametrize("block", [1000, 8])
def test_near_dups(spark, empty, block, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", block)
    rows = sample() + near_copies()
    frame = spark.createDataFrame(rows, DOCS)
    got = near_dups.classes(frame).collect()
    assert collections.Counter(map(tuple, got)) == brute_classes(rows)
    if block == 1000:
        kept = near_dups.first_of_each(frame.withColumn("gone", F.lit("x")))
        assert kept.columns == frame.columns + ["gone"]
        firsts = {c for _, c in brute_classes(rows)}
        assert {r["doc_id"] for r in kept.collect()} == firsts
        assert near_dups.classes(empty).count() == 0


def test_first_of_each_goes_by_row(spark):
    rng = random.Random(21)
    a, b, c, d = (prose(rng, 60) + f" mark{i}" for i in range(4))
    rows = [(1, a, "en", "s", 0), (None, a, "en", "s", 0),  # a copy without an id
            (None, b, "en", "s", 0), (None, c, "en", "s", 0), (None, c + "!", "en", "s", 0),  # b is unique, c near
            (2, a, "en", "s", 0), (2, d, "en", "s", 0), (2, d, "en", "s", 0)]  # a used id, and rows that repeat
    kept = sorted(near_dups.first_of_each(spark.createDataFrame(rows, DOCS)).collect(), key=str)
    got = [(r["doc_id"], r["text"].rstrip("!")) for r in kept]
    assert collections.Counter(got) == collections.Counter([(1, a), (None, b), (None, c), (2, d)])


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    got = dict(map(tuple, components(Steps(spark, "test"), spark.createDataFrame(links, "a long, b long")).collect()))
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {x: root(x) for a, b in links if a != b for x in (a, b)}


def test_licenses(spark, docs, empty):
    notice = licenses.NOTICES[0][1].split()
    broken = " ".join(notice[:9] + ["oddly"] + notice[9:])
    rows = [(1, "x Licensed under CC BY-NC 4.0. mit license, MIT License", "", "", 0), (2, "GNU general public licence", "", "", 0),
            (3, "intro " + broken + " outro", "", "", 0), (4, "the gnu general public license, version 3", "", "", 0)]
    frame = docs.unionByName(spark.createDataFrame(rows, DOCS).withColumn("doc_id", F.col("doc_id") + 1000))
    got = collections.defaultdict(list)
    for r in licenses.scan(frame).collect():
        got[r["doc_id"]].append(r)
    assert sum(map(len, got.values())) == frame.count()
    for r in frame.collect():
        w = words_of(r["text"])
        at = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w))
              if w[i:i + len(p.split())] == p.split()]
        want = (len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
                ",".join(sorted({x for _, x in at})))
        assert want in [(g["n_words"], g["n_base"], g["first_word"], g["last_word"], g["base_labels"])
                        for g in got[r["doc_id"]]]
    assert got[1001][0]["labels"] == "cc-by,cc-by-nc,mit" and got[1002][0]["labels"] == ""
    assert got[1003][0]["labels"] == "mit" and got[1003][0]["n_base"] == 0
    assert got[1004][0]["labels"] == "gpl" and all(0 <= g["score"] <= 1 for x in got.values() for g in x)
    assert licenses.scan(empty).count() == 0


PAGES = "page_id long, url string, html string"


def test_url_rules(spark):
    cases = {
        None: ("", "", None, "allow"), "no scheme": ("", "", None, "allow"),
        "http://WWW.Example.COM/en/1?x#y": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://a.example.com/en/1": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "https://x.com": ("x.com", "", None, "allow"), "https://x.com/": ("x.com", "/", "com/", "allow"),
        "http://b.net/es/?q=a://z": ("b.net", "/es/", "net/es/", "block"), "http://notnet/es/": ("notnet", "/es/", None, "allow"),
        "ftp://h.net?x/fr/": ("h.net", "", None, "allow"), "a://b.org/c://d": ("b.org", "/c://d", None, "allow"),
    }
    rows = [(i, u, "<p>free pills casino games win cheap</p>" * 3) for i, u in enumerate(cases)]
    rows += [(100 + i, f"http://{h}.org/de/{i}", None) for i, h in enumerate(
        ["plain", "quiet", "calm", "soft", "kind", "even", "cheappills", "cheap-pills", "freecasino", "casino-win"])]
    rows.append(rows[-1])
    got = url_filters.judge(spark.createDataFrame(rows, PAGES)).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: r for r in got}
    for i, want in enumerate(cases.values()):
        assert tuple(by_id[i][c] for c in ("host", "path", "rule", "verdict")) == want
    assert by_id[106]["words"] == "cheap pills org" and by_id[108]["words"] == "free casino org"
    assert [by_id[i]["verdict"] for i in range(100, 110)] == ["allow"] * 6 + ["block"] * 4
    assert url_filters.judge(spark.createDataFrame([], PAGES)).count() == 0


def test_html_blocks():
    page = ("<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a>Home</a></nav>"
            "<article><h1>Head &amp; tail</h1><p>One<br>two &lt;b&gt; <b>bo</b>ld<p>Three&nbsp;four"
            "<script>if (a < b) {'</p>'}</script><div class='comments'><p>Reader</p></div><aside>Side</aside></article>"
            "<!-- <p>hidden</p> --><footer>Foot</footer></body>")
    assert [t for t, _ in html_text.blocks(page)] == ["Head & tail", "One two <b> bold", "Three four"]
    plain = "<body><div class=\"cookie-notice\"><p>We use</p></div><div><p>Text a</p><p>Text b</p></div><form>F</form></body>"
    assert [t for t, _ in html_text.blocks(plain)] == ["Text a", "Text b"]
    assert html_text.blocks("") == [] and [t for t, _ in html_text.blocks("bare < text")] == ["bare < text"]
    assert [t for t, _ in html_text.blocks("<p a=\"x>y\">in</p><p>cut <b")] == ["in", "cut"]


def test_html_names_within_an_article():
    """Within an article one word of a name is no ground to drop; outside it is."""
    page = ("<body><div class='copyright'>C</div><div id='disclaimer'>D</div><article><header><h1>H</h1><p>Lead</p>"
            "<nav>N</nav></header><div class='article-header'><h2>H2</h2></div><p class='notice'>One</p>"
            "<div class='widget-text'>Two</div><section class='related-work'>Three</section>"
            "<div class='share-buttons'>S</div><div class='related posts'>R</div><div class='ad'>A</div>"
            "<div class='comments'><p>Said</p></div><footer>F</footer><p>Four</p></article></body>")
    assert [t for t, _ in html_text.blocks(page)] == ["H", "Lead", "H2", "One", "Two", "Three", "Four"]
    plain = "<body><div class='author-bio'>B</div><ul class='tags'><li>T</li></ul><p>Text</p><div id='copyright'>C</div></body>"
    assert [t for t, _ in html_text.blocks(plain)] == ["Text"]


def brute_texts(pages):
    """What main_texts is to give, with every head of every page counted in one place."""
    cuts = {row: html_text.blocks(row[2] or "") for row in pages}
    host = {row: row[1].split("/")[2] if row[1] and "://" in row[1] else "" for row in pages}

    def heads(texts):
        words, out = [w for t in texts for w in words_of(t)], set()
        out |= {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
        return out | {tuple(words_of(t)) for t in texts if 0 < len(words_of(t)) < 5}
    contents = collections.defaultdict(set)
    for row, cut in cuts.items():
        if cut:
            contents[host[row], not cut[0][1]].add(tuple(t for t, _ in cut))
    told = collections.defaultdict(set)
    for key, lists in contents.items():
        on = collections.Counter(h for texts in lists for h in heads(texts))
        told[key] = {h for h, n in on.items() if n > 1 and (
            n >= html_text.OUTSIDE * len(lists) if key[1] else n >= html_text.MANY and 2 * n > len(lists))}
    out = {}
    for row, cut in cuts.items():
        texts, repeated = [t for t, _ in cut], told[host[row], bool(cut) and not cut[0][1]]
        words, covered, at = [w for t in texts for w in words_of(t)], set(), 0
        for i in range(len(words) - 4):
            if tuple(words[i:i + 5]) in repeated:
                covered |= set(range(i, i + 5))
        left = []
        for t in texts:
            n = len(words_of(t))
            if 0 < n < 5 and tuple(words_of(t)) in repeated:
                covered |= set(range(at, at + n))
            if not n or len(covered & set(range(at, at + n))) / n < html_text.COVERED:
                left.append(t)
            at += n
        out[row] = "\n".join(left)
    return out


@pytest.mark.parametrize("sent", [None, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_html_equals_brute_force(spark, seed, sent, monkeypatch):
    """Pages without telling names: what goes is what their host repeats, spread over tasks one by one."""
    rng = random.Random(seed)
    pieces = [prose(rng, rng.randint(1, 12)) for _ in range(6)]
    pages = []
    for i in range(90):
        own = [prose(rng, rng.randint(2, 30)) + f" x{rng.random()}" for _ in range(rng.randint(0, 3))]
        texts = own + [p for p in pieces if rng.random() < rng.choice([.05, .3, .9])]
        rng.shuffle(texts)
        tag = rng.choice(["div", "article", "section"])
        pages.append((i, f"http://h{rng.choice([1, 1, 1, 2, 3, rng.randint(4, 40)])}.org/{i}", body(*texts, tag=tag)))
    pages += [(200 + i, "http://h1.org/copy", pages[3][2]) for i in range(30)] + [(300, None, body(*pieces)), (301, "x", None)]
    frame = spark.createDataFrame(pages + pages[:5], PAGES).repartition(7)
    want, found = brute_texts(pages), html_text.main_texts(frame, sent).collect()
    by_id = {row[0]: text for row, text in want.items()}
    assert len(found) == len(pages) + 5 and {r["page_id"]: r["text"] for r in found} == by_id
    assert sum(by_id[row[0]] != "\n".join(t for t, _ in html_text.blocks(row[2] or "")) for row in pages) > 20


def test_html_of_no_pages_and_clashing_columns(spark):
    assert html_text.main_texts(spark.createDataFrame([], PAGES)).collect() == []
    rows = [(i, f"http://h.org/{i}", body("same words on all of these", f"own {i} " * 3), "x", 1) for i in range(4)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string, page int")
    assert [r["text"] for r in html_text.main_texts(frame).orderBy("page_id").collect()] == [
        ("own %d " % i * 3).strip() for i in range(4)]


def test_html_boilerplate_of_a_host(spark):
    rng = random.Random(6)
    banner = " ".join(f"w{i}" for i in range(60))
    pages = [(i, f"http://h.org/{i}", f"<body><div><p>{banner}</p><p>Own text {rng.random()} of page {i}</p></div></body>")
             for i in range(6)]
    quoted = " ".join(f"q{i}" for i in range(60))
    pages += [(10 + i, f"http://a.org/{i}", f"<article><p>{quoted}</p><p>Article {i}</p></article>") for i in range(4)]
    pages += [(20, None, None), (21, "x", ""), pages[0]]
    got = {r["page_id"]: r for r in html_text.main_texts(spark.createDataFrame(pages, PAGES)).collect()}
    for i in range(6):
        assert got[i]["text"].startswith("Own text") and got[i]["n_chars"] == len(got[i]["text"])
    assert all(got[10 + i]["text"] == f"{quoted}\nArticle {i}" for i in range(4))  # nothing of an article is lost
    assert got[20]["text"] == got[21]["text"] == ""


def body(*texts, tag="div"):
    return f"<body><{tag}>" + "".join(f"<p>{t}</p>" for t in texts) + f"</{tag}></body>"


@pytest.mark.parametrize("sent", [None, 0])
def test_html_short_repeats_and_copies(spark, sent):
    rng = random.Random(7)

    def own(i):
        return " ".join(f"t{rng.randint(0, 10**9)}" for _ in range(40)) + f" end{i}"
    texts = {i: own(i) for i in range(100)}
    pages = [(i, f"http://h.org/{i}", body(texts[i], "Share this page with your friends", "Subscribe now"))
             for i in range(8)]  # repeats of six and of two tokens
    copied = [(20, "http://m.org/a", body(texts[20])), (21, "http://m.org/a?x=1", body(texts[20])),
              (22, "http://m.org/b", body(texts[22]))]
    articles = [(30, "http://q.org/1", body(texts[30], tag="article")), (31, "http://q.org/2", body(texts[30]))]
    rare = [(40 + i, f"http://r.org/{i}", body(texts[40 + max(i, 1)], f"own{i}")) for i in range(40)]  # two of 40 share a text
    frame = spark.createDataFrame(pages + copied + [copied[0], copied[2]] + articles + rare, PAGES)
    got = {r["page_id"]: r["text"] for r in html_text.main_texts(frame, sent).collect()}
    assert all(got[i] == texts[i] for i in range(8))
    assert got[20] == got[21] == texts[20] and got[22] == texts[22]
    assert got[30] == got[31] == texts[30]
    assert got[40] == texts[41] + "\nown0" and got[41] == texts[41] + "\nown1"


def test_mixing_equals_sql(spark, docs, empty):
    con = duckdb.connect()
    frame = docs.unionByName(spark.createDataFrame(
        [(500 + i, "w " * (1 + i % 30), "en", f"s{i % 7}" if i % 9 else None, 0) for i in range(200)], DOCS))
    con.register("documents", frame.toArrow())
    want = con.execute(mixing.ORACLE).fetchall()
    got = [tuple(r) for r in mixing.mix(frame).collect()]
    exact = {d for d in (r[0] for r in want) if d != 1}  # id 1 has texts of one rank
    key = lambda rows: sorted((r for r in rows if r[0] in exact), key=str)
    assert key(got) == key(want)
    assert len(got) == frame.count() and all(r[4] <= 3 * r[1] for r in got)
    clash = mixing.mix(frame.withColumn("u", F.lit("mine")).withColumn("edge", F.lit(1)), keep=("text", "u", "edge"))
    assert clash.columns == ["doc_id", "size", "source_size", "target", "taken", "text", "u", "edge"]
    assert {r["u"] for r in clash.collect()} == {"mine"}
    assert mixing.mix(empty).count() == 0


def test_mixing_cuts_within_equal_rows(spark):
    con = duckdb.connect()
    hot = [(1, f"{i} w w", "en", "hot", 0) for i in range(1000)] + [(None, f"{i} v v", "en", None, 0) for i in range(1000)]
    hot += [(700 + i, "x " * (i % 40), "en", f"t{i % 4}", 0) for i in range(160)]
    frame = spark.createDataFrame(hot, DOCS).repartition(5)
    con.register("documents", frame.toArrow())
    want = collections.Counter(con.execute(mixing.ORACLE).fetchall())
    assert len({r[4] for r in want if r[0] == 1 and r[1] == 3}) > 1  # a tie is cut
    assert collections.Counter(tuple(r) for r in mixing.mix(frame).collect()) == want
    kept = mixing.mix(frame, keep=("text",)).collect()
    assert collections.Counter(tuple(r)[:5] for r in kept) == want
    assert collections.Counter(r["text"] for r in kept) == collections.Counter(r["text"] for r in frame.collect())


def test_targets_share_the_excess(spark):
    sources = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 40)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.with_targets(Steps(spark, "test"), sources).collect()}
    assert got["a"] == 30 and sum(got.values()) == pytest.approx(1550)
    assert got["b"] / got["c"] == pytest.approx(2) and got[None] == 120


def brute_lines(rows):
    order = sorted({(r[0] is None, r[0] or 0, r[1]) for r in rows if r[1] is not None}, key=lambda x: x[:2])
    first, gone = {}, set()
    for without, doc, text in order:
        for i, line in enumerate(text.split("\n")):
            if line.strip():
                first.setdefault(line, (without, doc, text, i))
    lines = list(first)
    for j, b in enumerate(lines):
        if len(b) >= line_dedup.LEAST and any(
                len(a) >= line_dedup.LEAST and line_dedup.within_one_edit(a, b) for a in lines[:j]):
            gone.add(b)
    out = {}
    for without, doc, text in order:
        out[(None if without else doc), text] = "\n".join(
            x for i, x in enumerate(text.split("\n"))
            if not x.strip() or (first[x] == (without, doc, text, i) and x not in gone))
    return out


def test_line_dedup(spark, empty):
    rng = random.Random(12)
    base = [" ".join(rng.choice(["sea", "wind", "über", "stone", "aa", "aab"]) for _ in range(8)) for _ in range(12)]
    rows = []
    for i in range(40):
        picked = []
        for _ in range(rng.randint(1, 6)):
            x = rng.choice(base)
            p = rng.randrange(len(x))
            picked.append(rng.choice([x, x, x[:p] + x[p + 1:], x[:p] + "z" + x[p:], x[:p] + "y" + x[p + 1:], "short", ""]))
        rows.append((i, "\n".join(picked), "en", "s", 0))
    rows += [(100, None, None, None, None), (101, "", "", "", 0), (102, "\n\n", "", "", 0), (None, base[0], "", "", 0),
             rows[3], (103, "x" * 70_000, "", "", 0), (104, "x" * 70_001, "", "", 0)]
    frame = spark.createDataFrame(rows, DOCS)
    want = brute_lines(rows)
    got = line_dedup.dedup(frame).collect()
    assert len(got) == len(rows)
    for r, before in zip(sorted(got, key=lambda r: str(r["doc_id"])), sorted(rows, key=lambda r: str(r[0]))):
        assert r["text"] == (None if before[1] is None else want[before[0], before[1]])
    kept = line_dedup.deduped_documents(frame.withColumn("n_kept", F.lit(5)).withColumn("row", F.lit(6)))
    assert kept.columns == frame.columns + ["n_kept", "row"]
    ids = {r["doc_id"] for r in kept.collect()}
    assert {100, 101, 102, 103} <= ids and 104 not in ids
    assert line_dedup.dedup(empty).count() == 0


def test_line_dedup_with_clashing_columns(spark):
    rows = [(i, "the same line on all of these\nown line of number " + "abcdef"[i] * 6, i, "r", "k", 9) for i in range(4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, of int, of_row string, kept string, n_lines int")
    found = line_dedup.dedup(frame).orderBy("doc_id").collect()
    assert [(r["of"], r["of_row"], r["kept"], r["n_lines"], r["n_kept"]) for r in found] == [
        (0, "r", "k", 2, 2), *((i, "r", "k", 2, 1) for i in (1, 2, 3))]


def test_line_dedup_of_short_lines_and_blank_rests(spark):
    rows = [(1, "All rights!\n\nsecond line of it", "", "", 0), (2, "All rights!\n\nsecond line of it", "", "", 0),
            (3, "All right!\nthird text here", "", "", 0), (4, " \n\n", "", "", 0), (5, None, "", "", 0)]
    kept = {r["doc_id"]: r["text"] for r in line_dedup.deduped_documents(spark.createDataFrame(rows, DOCS)).collect()}
    assert kept == {1: rows[0][1], 3: "third text here", 4: " \n\n", 5: None}


def test_queries_over_whole_tables(spark, sf_dir):
    import __spark_entry__ as entry
    from tidemark.llm.queries import QUERIES
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    n = duckdb.sql(f"select count(*) from '{sf_dir}/documents.parquet'").fetchall()[0][0]
    for name in ("op2_decontamination", "op3_token_counts", "op9_mixing", "op12_fill_middle"):
        assert QUERIES[name](spark, sf_dir).count() == n


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("score", F.lit("own"))
    steps = Steps(spark, "pipeline-test")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = steps.keep(stage(spark, docs, sf_dir))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
            assert 0.5 * docs.count() <= out.count() <= docs.count(), name
            docs = out
    assert out.count() > 0 and out.agg(F.min("taken")).first()[0] > 0


def test_pipeline_of_no_documents(spark, sf_dir, empty):
    import corpus_pipeline
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0, name
