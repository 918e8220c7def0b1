"""Edge cases of each operator: nulls, empty and very long texts, ties, repeats, empty
tables, clashing names; and what single functions promise."""

from __future__ import annotations

import collections
import gzip
import io
import itertools
import math
import random
import time
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from covermonth.llm import brown, html_text, langid, packing, secrets, warc
from covermonth.llm.components import components
from covermonth.llm.decontaminate import best_overlap, clean_documents, contamination
from covermonth.llm.filters import bitmap, possible
from covermonth.llm.minhash import near_duplicates
from covermonth.llm.quality import (
    POLICIES,
    ablations,
    apply_policy,
    compare_policies,
    ledger,
    measures,
    repeated_words,
)
from covermonth.llm.queries import tokenizer_path
from covermonth.llm.scratch import BATCH_BYTES, Scratch
from covermonth.llm.sharding import kd_shards

# Names that operators use inside: as further columns they must not matter.
CLASHING = ["node", "bucket", "size", "n", "row", "piece", "g", "cell", "shard", "root", "words",
            "length", "held_out", "digest", "word", "score"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(seed, count=60):
    choose = random.Random(seed)
    return " ".join("".join(choose.choices("abcdefghij", k=4)) for _ in range(count))


LONG = sentence(99, 60_000)
ROWS = [
    (1, sentence(1), "en", "a", None), (2, sentence(1), "en", "b", 5), (2, sentence(1), "en", "b", 5),
    (3, None, None, None, None), (4, "", "en", None, 0), (None, sentence(2), None, "a", 1),
    (None, None, None, None, None), (5, " \t\n", "de", "a", 3), (6, LONG, "de", "a", 9),
    (7, "one two", "en", "a", 7), (8, "one two", "en", "a", 7), (9, "é ß 漢字 🙂", "de", "c", 9),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, DOCS)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def rows(df):
    return [r.asDict() for r in df.collect()]


# --- near duplicates -------------------------------------------------------

def test_near_duplicates_of_odd_rows(docs, nothing):
    found = rows(near_duplicates(docs))
    assert len(found) == len(ROWS)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert [by_id[d]["component_id"] for d in (1, 2, 3, 4, 5, 6, 7, 8)] == [1, 1, 3, 4, 5, 6, 7, 7]
    assert [by_id[d]["n_shingles"] for d in (3, 4, 5, 7)] == [0, 0, 0, 1]
    assert {d for d, r in by_id.items() if r["kept"]} == {1, 3, 4, 5, 6, 7, 9}
    assert all(r["kept"] for r in found if r["doc_id"] is None)
    assert near_duplicates(nothing).count() == 0


def jaccard_groups(texts, size, threshold):
    sets = {}
    for d, t in texts.items():
        w = t.split()
        sets[d] = {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    group = {d: d for d in texts}
    for a, b in itertools.combinations(sorted(texts), 2):
        common = len(sets[a] & sets[b])
        if common and common >= threshold * len(sets[a] | sets[b]) and group[a] != group[b]:
            low, high = sorted((group[a], group[b]))
            group = {d: low if g == high else g for d, g in group.items()}
    return group


def test_near_copies_around_the_threshold(spark, monkeypatch):
    """A large group whose pairs lie on both sides of the threshold, in blocks of 16."""
    monkeypatch.setattr("covermonth.llm.minhash.BLOCK", 16)
    texts = {}
    for d in range(300):
        words, choose = sentence(7, 100).split(), random.Random(d)
        for _ in range(choose.randrange(0, 6)):
            words[choose.randrange(100)] = f"new{choose.random()}"
        texts[d] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for size, threshold in ((3, Fraction(85, 100)), (5, Fraction(4, 5))):
        found = {r.doc_id: r.component_id for r in near_duplicates(df, size, threshold).collect()}
        assert found == jaccard_groups(texts, size, threshold)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    edges = spark.createDataFrame([*chain, *star, (7, 7), (1, 0)], "a long, b long")
    found = {r.node: r.root for r in components(edges, Scratch(spark, "t"), "c").collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components(edges.where("false"), Scratch(spark, "t"), "c").count() == 0


def test_python_tasks_get_batches_bounded_by_bytes(spark):
    """Batches of a row limit alone grow with the texts, in memory outside of Spark's heap."""
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    texts = spark.range(0, 60, 1, 1).select(F.repeat(F.lit("x"), 500_000).alias("text"))
    found = Scratch(spark, "t").save(texts.mapInArrow(sizes, "rows long, bytes long"), "sizes").collect()
    assert sum(r.rows for r in found) == 60
    assert max(r.bytes for r in found) <= BATCH_BYTES + 600_000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None


def test_bitmap(spark):
    values = [0, 1, -1, 2**62, -2**63, 123456789123]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v long")
    for probes in (1, 3):
        bits = bitmap(df, "v", probes)
        assert possible(bits, np.array(values, np.int64), probes).all()
        others = np.random.default_rng(0).integers(-2**63, 2**63, 10_000, np.int64)
        assert possible(bits, others, probes).mean() < 0.01


# --- quality ----------------------------------------------------------------

def test_ledger_of_odd_rows(docs, nothing):
    found = rows(ledger(docs))
    assert len(found) == len(ROWS)
    null, empty = (next(r for r in found if r["doc_id"] == d) for d in (3, 4))
    assert {**null, "doc_id": 0} == {**empty, "doc_id": 0}
    assert null["failed_bits"] == 1 and null["n_words"] == 0
    assert ledger(nothing).count() == 0


def test_policies_and_ablations_agree_with_rows(docs):
    table = ledger(docs)
    for version in POLICIES:
        kept = rows(apply_policy(table, version))
        total = sum(r["kept"] for r in kept)
        assert {r["kept"] for r in rows(ablations(table, version))} == {total}
        assert {r["policy"]: r["kept"] for r in rows(compare_policies(table))}[version] == total
    for r in rows(ablations(table, "prose-2")):
        bit = 1 << POLICIES["prose-2"].index(r["rule"])
        assert r["failing_alone"] == sum(x["failed_bits"] == bit for x in rows(table))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12))
def test_repeated_words(words):
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    assert repeated_words(words) == len(covered)


def test_measures():
    names = dict(zip(
        ("words", "chars", "symbols", "dup_lines", "repeat", "lines", "letters"),
        measures("Ab c\nAb c\n\n \n#1 é\nAb c"), strict=False))
    assert names == {"words": 8, "chars": 12, "symbols": 1, "dup_lines": 2, "repeat": 0, "lines": 4,
                     "letters": 7}


# --- languages --------------------------------------------------------------

def test_languages_of_odd_rows(spark, docs, nothing):
    model = langid.train(docs.select("text", "lang"))
    assert model.languages == ["de", "en"]
    found = docs.select("doc_id", langid.predict(F.col("text"), model, spark).alias("p"))
    by_id = {r.doc_id: r.p for r in found.collect()}
    assert [by_id[d].lang for d in (3, 4, 5, 6)] == ["und", "und", "und", "de"]
    assert by_id[3].score == 0 and by_id[3].mixture == []
    untrained = langid.train(nothing.select("text", "lang"))
    assert untrained.languages == []
    found = docs.select(langid.predict(F.col("text"), untrained, spark).alias("p"))
    assert {r.p.lang for r in found.collect()} == {"und"}


def test_mixture_finds_both_languages():
    likelihood = np.array([[0.0, -20.0, -20.0], [-20.0, 0.0, -20.0], [-20.0, -20.0, 0.0]])
    shares = langid.mixture(likelihood, np.array([60.0, 40.0, 0.0]))
    assert sorted(shares) == [0, 1]
    assert shares[0] == pytest.approx(0.6, abs=0.02)
    assert list(langid.mixture(likelihood, np.array([60.0, 1.0, 0.0]))) == [0]


# --- class-based model ------------------------------------------------------

def test_scores_of_odd_rows(docs, nothing):
    held_out = F.coalesce(F.col("doc_id") == 6, F.lit(False))
    found = rows(brown.score(docs, held_out))
    assert len(found) == len(ROWS)
    null = next(r for r in found if r["doc_id"] == 3)
    assert null["n_tokens"] == 1 == null["n_known"]
    assert all(r["score"] < 0 and r["base_score"] < 0 for r in found)
    assert brown.score(nothing, F.lit(False)).count() == 0
    untrained = rows(brown.score(docs, F.lit(True)))
    assert {(r["n_known"], r["train_tokens"]) for r in untrained} == {(0, 0)}
    # All that is left is the share of unseen words, which is all.
    assert all(r["score"] == pytest.approx(r["base_score"]) == 0 for r in untrained)


def test_words_are_counted_without_sorting_and_passes_read_numbers_only(docs, monkeypatch):
    plans, save = {}, Scratch.save

    def keep_plan(self, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return save(self, df, name)

    monkeypatch.setattr(Scratch, "save", keep_plan)
    brown.score(docs, F.coalesce(F.col("doc_id") == 6, F.lit(False)))
    assert "SortAggregate" not in plans["counts"]
    scan = plans["pairs"][plans["pairs"].index("ReadSchema"):]
    assert "codes" in scan and "others" not in scan and "doc_id" not in scan


def test_words_outside_the_dictionary_are_joined(docs, monkeypatch):
    held_out = F.coalesce(F.col("doc_id") == 6, F.lit(False))
    whole = {r["n_tokens"]: r["base_score"] for r in rows(brown.score(docs, held_out))}
    monkeypatch.setattr(brown, "DICTIONARY", 20)
    small = {r["n_tokens"]: r["base_score"] for r in rows(brown.score(docs, held_out))}
    assert small == pytest.approx(whole)


def _kinds(spark, core, dictionary, monkeypatch):
    """Texts in which words of two kinds alternate, each kind with frequent and rare words; their model."""
    choose = random.Random(1)
    kinds = [[*[f"{k}{i}" for i in range(3)] * 9, *[f"{k}x{i}" for i in range(9)]] for k in "ab"]
    texts = [(n, " ".join(choose.choice(kinds[k % 2]) for k in range(50)), n >= 180)
             for n in range(200)]
    monkeypatch.setattr(brown, "CORE", core)
    monkeypatch.setattr(brown, "DICTIONARY", dictionary)
    scratch = Scratch(spark, "t")
    docs = spark.createDataFrame(texts, "doc_id long, text string, held_out boolean")
    words, counts, outside, codes = brown.encode(docs, scratch)
    model, others = brown.train(codes.where("NOT held_out"), counts, outside, scratch)
    classes = dict(zip(words, model.class_of, strict=False))
    by_hash = {r["hash"]: r for r in others.collect()}
    assert len(by_hash) == outside
    for word in {w.encode() for ws in kinds for w in ws} - set(words):
        row = by_hash[int(np.uint64(xxhash.xxh64_intdigest(word)).view(np.int64))]
        classes[word] = row["class"]
    return docs, model, classes, [{w.encode() for w in ws} for ws in kinds]


def test_tasks_of_the_class_model_hand_on_small_batches():
    """An Arrow batch of Spark holds 10,000 rows, which lie outside of its heap."""
    rng = np.random.default_rng(1)
    codes = [rng.integers(0, brown.DICTIONARY, 400, np.int32) for _ in range(1500)]
    texts = pa.RecordBatch.from_pydict({
        "codes": pa.array([np.append(c, np.int32(0)).tobytes() for c in codes], pa.binary())})
    class_of = np.append(np.arange(brown.DICTIONARY) % brown.CLASSES, brown.REST)
    found = list(brown._neighbours(iter([texts]), class_of))
    rows = [row for batch in found for row in batch.to_pylist()]
    assert max(len(row["keys"]) for row in rows) <= 4 * brown.PIECE
    beyond = sum(int((c >= brown.CORE).sum()) for c in codes)
    assert sum(int(np.frombuffer(row["times"], np.int32).sum()) for row in rows) == 2 * beyond
    pairs = [rng.integers(0, brown.CORE, 400, np.int32) for _ in range(1500)]
    texts = pa.RecordBatch.from_pydict({"codes": pa.array([c.tobytes() for c in pairs], pa.binary())})
    counted = list(brown._count_pairs(iter([texts])))
    assert max(batch.num_rows for batch in counted) <= brown.CELLS
    assert sum(sum(batch.column("n").to_pylist()) for batch in counted) == 1500 * 400


@pytest.mark.parametrize(("core", "dictionary"), [(2048, 1 << 18), (7, 1 << 18), (7, 12)])
def test_every_word_is_classed_by_its_neighbours(spark, monkeypatch, core, dictionary):
    """In rounds, placed in tasks, and outside the dictionary: the kinds never share a class."""
    _, model, classes, kinds = _kinds(spark, core, dictionary, monkeypatch)
    found = [{classes[w] for w in ws} for ws in kinds]
    assert not found[0] & found[1]
    assert (10 ** model.transitions).sum(axis=1) == pytest.approx(1)


@pytest.mark.parametrize("dictionary", [1 << 18, 12])
def test_scores_are_those_of_the_counts(spark, monkeypatch, dictionary):
    """Scores from plain counts over the training texts, given each word's class."""
    docs, model, classes, _ = _kinds(spark, 7, dictionary, monkeypatch)
    texts = [(r.doc_id, [*r.text.encode().split(), brown.END], r.held_out) for r in docs.collect()]
    inside = {w for w, n in zip(classes, model.counts, strict=False)}
    counts, cells = collections.Counter(), collections.Counter()

    def pairs(tokens):
        for before, word in zip([brown.END, *tokens], tokens, strict=False):
            yield classes[before] if before in inside else brown.REST, word

    for _, tokens, held_out in texts:
        if not held_out:
            counts.update(tokens)
            cells.update((state, classes[word]) for state, word in pairs(tokens))
    total = sum(counts.values())
    of_class, distinct, of_state = (collections.Counter() for _ in range(3))
    for word, n in counts.items():
        of_class[classes[word]] += n
        distinct[classes[word]] += 1
    for (state, _), n in cells.items():
        of_state[state] += n

    def chance(state, word):
        c = classes[word]
        prior = (of_class[c] + 1) / (total + brown.CLASSES)
        return ((cells[state, c] + 10 * prior) / (of_state[state] + 10)
                * (counts[word] + 0.1) / (of_class[c] + 0.1 * (distinct[c] + 1)))

    monkeypatch.setattr(brown, "train", lambda *_: _trained(model, classes, counts, spark))
    found = {r["doc_id"]: r["score"] for r in brown.score(docs, F.col("held_out")).collect()}
    for doc, tokens, _ in texts:
        assert found[doc] == pytest.approx(sum(math.log10(chance(*p)) for p in pairs(tokens)))


def _trained(model, classes, counts, spark):
    words = [w for w in classes][len(model.counts):]
    return model, spark.createDataFrame(
        [(int(np.uint64(xxhash.xxh64_intdigest(w)).view(np.int64)), int(classes[w]), counts[w])
         for w in words], "hash long, class int, n long")


def test_best_class_is_that_of_the_likelihood():
    """Against the whole likelihood after each possible move, by the classes before a word."""
    choose = np.random.default_rng(3)
    for own in (brown.REST, 5):
        before = np.zeros(brown.STATES, np.int64)
        before[choose.integers(0, brown.STATES, 6)] = choose.integers(1, 50, 6)
        cells = choose.integers(0, 200, (brown.STATES, brown.CLASSES)).astype(float)
        if own < brown.CLASSES:
            cells[:, own] += before
        kinds = np.flatnonzero(before)
        found = brown.best_classes(cells, np.array([0]), kinds, before[kinds], np.array([own]))

        def value(c, cells=cells, before=before, own=own):
            moved = cells.copy()
            if own < brown.CLASSES:
                moved[:, own] -= before
            moved[:, c] += before
            return brown._xlogx(moved).sum() - brown._xlogx(moved.sum(axis=0)).sum()

        assert found[0] == max(range(brown.CLASSES), key=value)


# --- html ---------------------------------------------------------------------

def test_main_text_of_odd_pages(spark):
    pages = [None, "", "<p>", "no tags at all, only text of some length that goes on and on and on",
             "<article><p>A &amp; B&nbsp;&#233;<br>C<p>D<b>E</b>F</article><nav>x</nav>",
             "<article><p>a < b and c</p><!-- <p>no</p> --><script>var x='</p>'</script></article>",
             "<article>" + "<p>word</p>" * 20_000 + "</article>"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    found = [r.t for r in df.select("i", html_text.main_text(F.col("html")).alias("t"))
             .orderBy("i").collect()]
    assert found[:3] == ["", "", ""]
    assert found[3] == pages[3]
    assert found[4:6] == ["A & B é C\nDEF", "a < b and c"]
    assert found[6] == "\n".join(["word"] * 20_000)
    assert df.where("false").select(html_text.main_text(F.col("html"))).count() == 0


def test_skipped_elements_end_where_they_end():
    """Nothing behind a tag that only looks like a skipped one, is empty or has no end tag is lost."""
    for odd in ("<svg-icon name='x'></svg-icon>", "<video-player src='x'></video-player>",
                "<audio-player></audio-player>", "<title-bar></title-bar>", "<script-x></script-x>",
                "<svg viewBox='0 0 1 1'/>", "<SVG />", "<script src='x'/>", "<noscript>", "<object>",
                "<canvas>", "<video src=a/>", "<iframe>", "<select>", "<svg><svg>no</svg>no</svg>",
                "<video src=a><svg>no</svg>", "<script src=a/>no</script >", "<style>no</style>",
                "<svg><title>no</title></svg>", "<script>'<svg>'</script>"):
        page = f"<article><p>One {odd}two</p><p>three</p><p>four</p></article><svg>no</svg>"
        assert [b.text for b in html_text.blocks(page)] == ["One two", "three", "four"], odd
    formula = "<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds</p>"
    assert [b.text for b in html_text.blocks(formula)] == ["So x=1 holds"]
    assert [b.text for b in html_text.blocks("<p>One</p><script>no<p>no")] == ["One"]
    assert len(html_text.blocks("<p>One</p>" + "<svg>" * 50_000 + "<p>two</p>")) == 2


def test_main_content_in_containers_named_like_furniture():
    tree = html_text.grow(*html_text.labelled())
    first = "The council met on Tuesday and agreed that the old bridge is to be repaired before the winter."
    text = f"<h1>Bridge</h1><p>{first}</p><p>Work begins soon.</p>"
    whole = f"Bridge\n{first}\nWork begins soon."
    aside = "<div class='{}'><p>Our shop has moved to the market square.</p></div>"
    for page in (
        f"<div class='content-sidebar-wrap'><main>{text}</main>{aside.format('sidebar')}</div>",
        f"<div class='layout-sidebar-right'><article>{text}</article></div>",
        f"<div class='content-with-sidebar'><div class='entry-content'>{text}</div></div>",
        f"<div class='sidebar'><main>{text}</main></div>",
        f"<div class='comments'><main>{text}</main></div>",
        f"<article>{text.replace('<h1>', '<header class=entry-header><h1>').replace('</h1>', '</h1></header>')}"
        "</article>",
        f"<main>{text}</main><div class='comments'><article class='post'><p>I crossed it once.</p></article></div>",
        f"<main>{text}</main><nav><article><p>Read on about bridges and rivers here.</p></article></nav>",
        f"<main>{text}</main><div class='related-posts'><article><p>The other bridge.</p></article></div>",
        f"<article>{text}</article>{aside.format('sidebar-primary')}",
    ):
        assert html_text.extract(f"<body>{page}</body>", tree) == whole, page


def test_tree_on_pages_that_it_was_not_grown_on():
    """Each labelled page by a tree grown on the others."""
    right = total = 0
    for page, marks in html_text.LABELLED:
        rest = [p for p in html_text.LABELLED if p[0] != page]
        parts = [(html_text.features(html_text.blocks(p)), m) for p, m in rest]
        tree = html_text.grow(np.concatenate([f for f, _ in parts]),
                              np.array([c == "+" for _, m in parts for c in m]))
        found = tree.predict(html_text.features(html_text.blocks(page)))
        right += sum(f == (m == "+") for f, m in zip(found, marks, strict=True))
        total += len(marks)
    assert right >= 0.9 * total


# --- packing --------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=80))
def test_plan_places_every_piece_once(lengths):
    counts = np.bincount(lengths, minlength=21)
    found = packing.plan(counts, 20)
    used = np.zeros(21, int)
    for pattern, times in found.patterns:
        assert sum(pattern) <= 20
        np.add.at(used, list(pattern), times)
    assert (used == counts).all()
    # Best-fit decreasing needs at most 11/9 of the fewest sequences, and 4.
    assert found.sequences <= 11 / 9 * -(-sum(lengths) // 20) + 4 + sum(
        length > 10 for length in lengths) / 2


def test_exact_complements_are_found():
    counts = np.zeros(21, int)
    counts[[12, 8, 11, 5, 4, 9, 6, 3, 2]] = 7
    counts[[8, 5]] = 7
    found = packing.plan(counts, 20)
    assert found.sequences == 7 * (12 + 8 + 11 + 5 + 4 + 9 + 6 + 3 + 2) // 20


def test_packing_of_odd_rows(docs, nothing):
    packed = packing.pack(docs, tokenizer_path())
    found = rows(packed)
    assert sum(r["piece"] == 0 for r in found) == len(ROWS)
    assert [r["length"] for r in found if r["doc_id"] in (3, 4)] == [1, 1]
    assert sum(r["doc_id"] == 6 for r in found) > 10
    ends = {}
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 4096
    assert packing.pack(nothing, tokenizer_path()).count() == 0


def test_sequences_hold_the_documents(docs):
    from tokenizers import Tokenizer

    some = docs.where("doc_id in (1, 3, 6, 7, 9)")
    packed = packing.pack(some, tokenizer_path())
    ids = {r.sequence_id: r.ids for r in packing.sequences(some, packed, tokenizer_path()).collect()}
    tokenizer = Tokenizer.from_file(tokenizer_path())
    text = {r[0]: r[1] or "" for r in ROWS}
    whole = {}
    for r in packed.orderBy("piece").collect():
        part = ids[r.sequence_id][r.offset:r.offset + r.length]
        whole.setdefault(r.doc_id, []).extend(part)
    for d, found in whole.items():
        assert found == [*tokenizer.encode(text[d], add_special_tokens=False).ids, 1]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_ids_word_by_word_are_those_of_the_text(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    (found,) = packing.WordIds(tokenizer_path()).of([text])
    assert found.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_of_every_letter_beside_stops():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    letters = [chr(c) for c in range(1, 0x2100)]
    texts = [f"ab{c}. x{c}, {c}'s {c}{c}1 A{c}B" for c in letters] + [
        "SERBESTİ. İ, a<|endoftext|>b don''t l'été ½\x85\xa0\x1cx"]
    found = packing.WordIds(tokenizer_path()).of(texts)
    expected = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [f.tolist() for f in found] == [e.ids for e in expected]


def test_the_memory_of_long_words_is_bounded(monkeypatch):
    """Words count by their bytes, however few they are."""
    monkeypatch.setattr(packing, "REMEMBERED", 1 << 18)
    words = packing.WordIds(tokenizer_path())
    texts = [chr(97 + i % 26) * (2000 + i) for i in range(300)]
    for text in texts:
        words.of([text])
        assert sum(map(len, words.number)) + words.flat.nbytes < packing.REMEMBERED + 20_000
    again = packing.WordIds(tokenizer_path()).of(texts[-3:])
    assert [x.tolist() for x in words.of(texts[-3:])] == [x.tolist() for x in again]



@pytest.mark.parametrize("seed", range(6))
def test_plans_need_no_more_than_best_fit(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(513, np.int64)
    chosen = rng.integers(1, 513, [600, 40, 300, 5, 200, 100][seed])
    np.add.at(counts, chosen if seed != 2 else np.maximum(chosen, 160), rng.integers(1, 9))
    plain = packing.Plan(512)
    packing._best_fit(counts.copy(), plain)
    found = packing.plan(counts, 512)
    assert found.sequences <= plain.sequences
    used = np.zeros(513, np.int64)
    for lengths, times in found.patterns:
        assert sum(lengths) <= 512
        np.add.at(used, list(lengths), times)
    assert (used == counts).all()


def test_the_index_of_sums_is_kept_up_to_date():
    rng = np.random.default_rng(1)
    left = rng.integers(0, 3, 40)
    left[0] = 0
    sums = packing.Sums(left)
    for _ in range(60):
        there = np.flatnonzero(left)
        if not len(there):
            break
        sums.take(np.array([rng.choice(there)]), np.array([1]))
        flags = (left > 0).astype(int)
        assert (sums.pairs == np.convolve(flags, flags)).all()
        for gap in range(1, 39):
            length = int(rng.choice(np.flatnonzero(left))) if left.any() else 1
            free = left.copy()
            free[length] -= 1
            there = [k for k in range(1, 40) for _ in range(min(3, free[k]))]
            possible = any(sum(c) == gap for r in (1, 2, 3) for c in itertools.combinations(there, r))
            found = sums.complement(length, gap) if left[length] else None
            if left[length]:
                assert (found is not None) == possible, (gap, length)
                assert found is None or sum(found) == gap


# --- archives ---------------------------------------------------------------------

PAGES = [(1, "http://a/\r\nX: y", "same"), (2, None, "same"), (2, None, "same"), (3, "http://b/é%", None),
         (4, "http://c/", ""), (None, "http://d/", "same"), (None, None, "other"),
         (5, "http://e/", "é" * 300_000)]


def test_archives_of_odd_rows(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn(
        "digest", F.lit("x")).withColumn("payload", F.lit(1))
    found = rows(warc.round_trip(df))
    assert len(found) == len(PAGES)
    kinds = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"])
                   for r in found)
    assert kinds == sorted([
        (1, "revisit", 2, 4), (2, "response", None, 4), (2, "response", None, 4),
        (3, "revisit", 4, 0), (4, "response", None, 0), (0, "revisit", 2, 4),
        (0, "response", None, 5), (5, "response", None, 600_000)])
    assert warc.round_trip(df.where("false")).count() == 0
    larger = rows(warc.round_trip(df, least_bytes=5))
    assert all(r["record_type"] == "response" for r in larger)


def archive(*records):
    return b"".join(gzip.compress(warc.record(*r)) for r in records)


def test_reader_verifies_what_it_reads():
    whole = archive((1, "http://a/", b"x" * 200_000, None), (2, None, b"x" * 200_000, 1))
    found = list(warc.read_records(io.BytesIO(whole)))
    assert [(r["page_id"], r["refers_to"]) for r in found] == [(1, None), (2, 1)]
    plain = warc.record(1, "http://a/", b"hello", None)
    for damaged in (plain.replace(b"hello", b"hallo"), plain.replace(b"hello", b"hell"),
                    plain + b"more", plain.replace(b"WARC/1.1", b"HTTP/1.1")):
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(gzip.compress(damaged))))
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.read_records(io.BytesIO(whole[:300])))


# --- secrets ------------------------------------------------------------------------

def test_guess_cost_orders_values():
    weak = ["password1", "qwertyuiop", "2019-12-25", "aaaaaaaaaaaa", "abcabcabcabc", "123456789012"]
    strong = ["x8Fk29sLqP0z", "Tr0ub4dor&3x!k", "0d82db9a40de89a262"]
    assert all(secrets.guess_cost(v) < secrets.LEAST_COST for v in weak)
    assert all(secrets.guess_cost(v) > secrets.LEAST_COST for v in strong)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_guess_cost_is_at_most_brute_force(value):
    assert secrets.guess_cost(value) <= sum(secrets._brute(value)) + 1e-9


def test_spans_and_masks(spark, docs, nothing):
    text = "é my pwd: x8Fk29sLqP0z and password=hunter2x; pwd: changeme AKIA" + "Z" * 16
    spans = secrets.spans_of(text)
    assert [(s[0], text[s[1]:s[2]]) for s in spans] == [
        ("guess", "x8Fk29sLqP0z"), ("assign", "password=hunter2x"), ("access", "AKIA" + "Z" * 16)]
    df = spark.createDataFrame([(1, text, 7), (2, None, None), (3, "", 0)],
                               "doc_id long, text string, n_chars long")
    masked = {r.doc_id: r for r in secrets.mask_secrets(df).collect()}
    assert masked[1].text == "é my pwd: [secret] and [secret]; pwd: changeme [secret]"
    assert masked[1].n_chars == len(masked[1].text)
    assert (masked[2].text, masked[2].n_chars, masked[3].text) == (None, None, "")
    assert secrets.mask_secrets(docs).columns == docs.columns
    assert secrets.mask_secrets(nothing).count() == 0


def test_credentials_in_aligned_settings():
    for text, value in (
        ("pwd          = Xk29#vQ!7zLm", "Xk29#vQ!7zLm"), ("pwd\t\t\t\t\t\t=\t\t\t\t\t\tXk29#vQ!7zLm", "Xk29#vQ!7zLm"),
        ("password:           'Xk29#vQ!7zLm'", "Xk29#vQ!7zLm"), ("pwd = Xk29,vQ!7zLm", "Xk29,vQ!7zLm"),
        ("(passphrase: Xk29;vQ(7zL)m).", "Xk29;vQ(7zL)m"), ("pwd is      Xk29#vQ!7zLm,", "Xk29#vQ!7zLm"),
        ("Server=x;Pwd=Xk29#vQ!7zLm;Database=sales", "Xk29#vQ!7zLm"),
        ("<b>pwd:</b> none <p>pwd: Xk29#vQ!7zLm</p>", "Xk29#vQ!7zLm"),
        ("private_key =\n      Xk29#vQ!7zLm", "Xk29#vQ!7zLm"), ("pwd: (Xk29#vQ!7zLm", "(Xk29#vQ!7zLm"),
    ):
        spans = secrets.spans_of(text)
        assert [(k, text[a:b]) for k, a, b, _ in spans] == [("guess", value)], text
    for text in ("pwd = changeme, pwd = changeme.", "pwd: <your-own-password>", "pwd: (optional)",
                 "pwd=changeme,user=somebody", "pwd" + " " * 100_000 + "x"):
        assert secrets.spans_of(text) == [], text
    both = "pwd=Xk29#vQ!7zLm,passphrase=Yw38#bN!6tRp"
    assert [both[a:b] for _, a, b, _ in secrets.spans_of(both)] == ["Xk29#vQ!7zLm", "Yw38#bN!6tRp"]


# --- decontamination --------------------------------------------------------------------

def test_overlaps_with_replaced_words(spark, docs, nothing):
    item = sentence(5, 30)
    words = item.split()
    words[4] = words[13] = words[22] = "other"
    texts = [(10, f"{sentence(6, 10)} {item.upper()}, {sentence(7, 10)}"),
             (11, f"{sentence(8, 200)} {' '.join(words)}"), (12, " ".join(item.split()[:9])),
             (13, sentence(9, 500)), (None, item), (14, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("seed", F.lit(1))
    items = spark.createDataFrame([(1, item), (2, "too short"), (3, None)], "item_id int, text string")
    found = {r.doc_id: r for r in contamination(df, items).collect()}
    assert set(found) == {10, 11, None}
    assert (found[10].matched, found[10].first_word, found[10].end_word) == (30, 10, 40)
    assert found[11].matched == 27 and found[11].item_id == 1
    assert {r.doc_id for r in clean_documents(df, items).collect()} == {12, 13, 14}
    assert clean_documents(docs, items).columns == docs.columns
    assert contamination(nothing, items).count() == 0
    assert contamination(df, items.where("false")).count() == 0


def test_clean_rows_stay_beside_contaminated_ones(spark):
    """Rows without doc_id, and rows that repeat one, are judged by their own texts."""
    item, clean = sentence(5, 30), [sentence(k, 50) for k in range(20, 24)]
    texts = [(None, item), (None, clean[0]), (None, clean[1]), (None, None), (1, f"so {item}"),
             (1, clean[2]), (2, clean[3]), (2, item.upper())]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {(r.doc_id, r.text) for r in clean_documents(df, items).collect()}
    assert found == {(None, clean[0]), (None, clean[1]), (None, None), (1, clean[2]), (2, clean[3])}


def test_every_allowed_replacement_is_found(spark):
    """Items of 8 to 16 words, any words replaced as long as 80 percent and 8 agree."""
    items = {n: sentence(1000 + n, n) for n in range(8, 17)}
    texts, expected = [], {}
    for n, item in items.items():
        for places in itertools.combinations(range(n), n - max(8, -(-n * 4 // 5))):
            words = [f"other{k}" if k in places else w for k, w in enumerate(item.split())]
            expected[len(texts)] = (n, n - len(places))
            texts.append((len(texts), f"{sentence(7, 3)} {' '.join(words)} {sentence(8, 3)}"))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    found = contamination(df, spark.createDataFrame(list(items.items()), "item_id long, text string"))
    matched = {r.doc_id: (r.item_id, r.matched) for r in found.collect()}
    assert set(matched) == set(expected)
    for d, (n, agree) in expected.items():
        assert matched[d][0] == n and min(13, 0.8 * n) <= matched[d][1] <= agree
    assert clean_documents(df, spark.createDataFrame(
        list(items.items()), "item_id long, text string")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.booleans(), max_size=25))
def test_best_overlap(same):
    start, end, matched = best_overlap(np.array(same, bool))
    score = [1 if s else -2 for s in same]
    best = max((sum(score[a:b]) for a in range(len(same) + 1) for b in range(a, len(same) + 1)))
    assert sum(score[start:end]) == best and matched == sum(same[start:end])


# --- shards -------------------------------------------------------------------------------

def test_shards_of_odd_rows(docs, nothing):
    for arguments in ({"shards": 3}, {"target_bytes": 100_000}, {"shards": 1}):
        found = rows(kd_shards(docs, **arguments))
        assert len(found) == len(ROWS)
        for shard in {r["shard"] for r in found}:
            slots = sorted(r["slot"] for r in found if r["shard"] == shard)
            assert slots == list(range(len(slots)))
        assert [(r["size"], r["text_crc32"]) for r in found if r["doc_id"] == 3] == [(1, 0)]
    assert kd_shards(nothing, shards=4).count() == 0


def test_one_text_that_is_most_of_the_table(spark):
    """Copies stay together while they fit, and are spread where they do not."""
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same " * 20))
        .when(F.col("id") < 40, F.lit("few " * 25))
        .otherwise(F.repeat(F.col("id").cast("string"), 25)).alias("text"))
    found = kd_shards(df, shards=8).groupBy("shard").agg(F.sum("size").alias("bytes")).collect()
    sizes = [r.bytes for r in found]
    assert len(sizes) == 8 and max(sizes) < 1.06 * min(sizes)


# --- pipeline -----------------------------------------------------------------------------

def test_stages_on_odd_rows(spark, docs, nothing):
    sf_dir = "/root/testdata/sf0.001"
    for df in (docs, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, sf_dir)
            assert out.columns == df.columns, name
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, df, sf_dir).collect()
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 7, 9]


# --- found in review --------------------------------------------------------------

@pytest.mark.parametrize("part", ["<a ", "<a \"", "<a '\"", "<!", "<a", "<script ", "</script ", "<a x='<b \""])
def test_broken_pages_take_linear_time(part):
    tree = html_text.grow(*html_text.labelled())
    for tail in ("", ">", "\">", "'>"):
        start = time.process_time()
        html_text.extract(part * (1_000_000 // len(part)) + tail, tree)
        assert time.process_time() - start < 5


def test_a_slash_closes_no_element():
    page = ("<html><body><article><h1>Head of it</h1><p>One two three four five six seven eight nine ten.</p>"
            "<div/><p>Second paragraph with quite a lot of words in it, more than ten.</p></div>"
            "<p>Third paragraph with quite a lot of words in it, more than ten.</p></article></body></html>")
    text = "\n".join(b.text for b in html_text.blocks(page))
    assert all(word in text for word in ("One", "Second", "Third"))


def test_quoted_attributes_hold_angle_brackets():
    found = html_text.blocks('<p title="a<b>c">one</p><p title=\'>\'>two</p><p x="y>three</p>')
    assert [b.text for b in found] == ["one", "two", '<p x="y>three']


@pytest.mark.parametrize("text", [
    "The secret is understanding your customers. A token was introduced last year.",
    "The password is responsible for access.", "compass: northwestern winds prevailed",
    "His passport: international travel", "Secret: Fundamentals of cooking"])
def test_prose_is_no_secret(text):
    assert [s for s in secrets.spans_of(text) if s[0] == "guess"] == []


@pytest.mark.parametrize("text,value", [
    ("db_pwd = Xk29#vQ!7zLm", "Xk29#vQ!7zLm"), ("userPwd: 'Xk29#vQ!7zLm'", "Xk29#vQ!7zLm"),
    ("The passphrase is Xk29vQ7zLmQ2 now", "Xk29vQ7zLmQ2"), ("pwd=qzjxkvwpmr", "qzjxkvwpmr")])
def test_credentials_are_secrets(text, value):
    assert value in [text[a:b] for kind, a, b, _ in secrets.spans_of(text) if kind == "guess"]


@pytest.mark.parametrize("text", ["½ ² ③ Ⅷ", "12 34", "☃ _ __"])
def test_numerals_are_no_letters(text):
    assert langid._WORD.findall(text) == []


def test_equal_texts_share_a_shard_unless_they_outweigh_one(spark):
    rows = [(i, f"text {i % 60} " + "x" * (i % 60 * 7)) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = kd_shards(df, shards=8)
    apart = (found.groupBy("text_crc32").agg(F.count_distinct("shard").alias("n")).where("n > 1"))
    assert apart.count() == 0
    heavy = df.unionAll(spark.range(400).selectExpr("id + 1000", "repeat('heavy ', 30)"))
    found = kd_shards(heavy, shards=8)
    assert found.where("size = 181").select("shard").distinct().count() > 3


def test_rows_that_share_an_id_lose_no_text(spark):
    rows = [(1, sentence(1)), (1, sentence(2)), (2, sentence(1)), (None, sentence(3)), (None, sentence(3)),
            (3, sentence(2)), (4, ""), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").select(
        F.lit(1).alias("row"), "*", F.lit(2).alias("c0"), F.lit(3).alias("component_id"))
    found = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert found.columns == df.columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in found.collect()))) == sorted(map(repr, [
        (1, sentence(1)), (1, sentence(2)), (None, sentence(3)), (4, ""), (None, None)]))


def test_masking_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([("secret=abcdef123", 16, "kept")], "text string, n_chars long, masked_text string")
    (row,) = secrets.mask_secrets(df).collect()
    assert (row.text, row.n_chars, row.masked_text) == ("[secret]", 8, "kept")


def test_words_of_no_item_are_marked_and_all_of_items_found():
    from covermonth.llm.decontaminate import PlainHashes, _seeds, _tokens

    known = PlainHashes()
    item = _tokens("one, two three four five six seven eight nine ten eleven", known)
    bits = np.zeros(1 << 18, np.uint64)
    for value in item.tolist():
        place = value & ((1 << 24) - 1)
        bits[place >> 6] |= np.uint64(1 << (place & 63))
    memory = PlainHashes(bits)
    text = _tokens("zero one two 'three' four five six seven eight other nine ten eleven -- words", memory)
    assert (text[1:9] == item[:8]).all() and (text[10:13] == item[8:]).all()
    assert not text[[0, 9, 13]].astype(np.uint64).__and__(np.uint64(1)).any()
    of_item = {int(s) for _, seeds in _seeds(item) for s in seeds}
    of_text = {int(s) for _, seeds in _seeds(text) for s in seeds}
    # Those windows of the text that stand in the item as well, by every mask.
    assert of_item & of_text == {
        int(s) for _, seeds in _seeds(item[:8]) for s in seeds}
