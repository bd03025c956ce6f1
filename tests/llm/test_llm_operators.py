"""Each operator against a plain version, and on nulls, ties, repeats, long texts and no rows."""

import hashlib
import html
import random
import re
import struct
import zlib
from collections import namedtuple
from fractions import Fraction
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import DATA
from tidemark.llm import (
    bpe,
    exact_dedup,
    html_extract,
    license_scan,
    line_dedup,
    ngram_join,
    quality_classifier,
    quality_rules,
    source_mix,
    token_counts,
)
from tidemark.llm.common import shared_folder
from tidemark.llm.components import components
from tidemark.llm.html_layouts import training_pages

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "lorem ipsum dolor " * 20_000 + "x" * 30_000
ODD = [
    (1, "a b c d e f g h i j k l", "en", "s1", 1), (2, "a  b c\td e f g h i j k l", "en", "s1", 1), (2, "a  b c\td e f g h i j k l", "en", "s1", 1),
    (3, None, None, None, None), (4, "", "en", "s2", 0), (None, "a b c d e f g h i j k l", "en", None, 1), (None, None, None, None, None),
    (5, LONG, "en", "s2", 1), (6, LONG, "en", "s1", 1), (7, "one", "en", "s1", 3), (8, "One", "en", "s1", 3), (9, "one two", "en", "s3", 7),
    (10, "p q r s\nt u v\nw x y\nz", "en", "s3", 1), (11, "0\np q r s\nt u v\nw x y\n1", "en", "s3", 1), (12, " \n \n \n \n ", "en", "s3", 1),
    (13, "漢字 <|endoftext|> é \U00010940 ՘ it's  12!", "zh", "s3", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with further columns whose names clash with results and helpers."""
    df = spark.createDataFrame(ODD, SCHEMA)
    for name in ("kept", "node", "size", "row", "score", "ids", "n_lines", "predicted", "decoded", "draws", "label", "__row", "TEXT2"):
        df = df.withColumn(name, F.lit("own"))
    return df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def key(row):
    return [(v is not None, str(v)) for v in row]


# --- tokens ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_bpe_round_trip_and_ids(odd, none, docs, library):
    for df in (odd, docs):
        out = bpe.decode(bpe.encode(df, PATH), PATH).collect()
        texts = [r.text or "" for r in df.collect()]
        assert [r.decoded for r in out] == texts
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [bytes(r.ids) for r in out] == [struct.pack(f"<{len(i)}I", *i) for i in want]
        assert [r.n_tokens for r in out] == [len(i) for i in want]
    assert bpe.decode(bpe.encode(none, PATH), PATH).count() == 0


def test_bpe_random_texts(library):
    rng, codec, decoder = random.Random(4), bpe.Codec(*bpe.load_tokenizer(PATH)), bpe.Decoder(*bpe.load_tokenizer(PATH))
    pieces = ["the", "ing", "  ", "\n", "'s", "é", "漢", "\U00010940", "\x85", "<|endoftext|>", "12", "!!", "ab" * 4, "　"]
    for _ in range(2000):
        text = "".join(rng.choice([rng.choice(pieces), rng.choice("abcdehnot '.")]) for _ in range(rng.randint(0, 25)))
        ids = library.encode(text, add_special_tokens=False).ids
        packed = codec.encode(text)
        assert packed == struct.pack(f"<{len(ids)}I", *ids)
        assert decoder.decode(packed) == text


def test_token_counts(odd, none, docs, library):
    for df in (odd, docs):
        got = sorted((tuple(r) for r in token_counts.token_counts(df, PATH).collect()), key=key)
        want = []
        for r in df.collect():
            n = len(library.encode(r.text or "", add_special_tokens=False).ids)
            want.append((r.doc_id, len((r.text or "").encode()), n, n > 1024))
        assert got == sorted(want, key=key)
    assert token_counts.token_counts(none, PATH).count() == 0


def test_long_words_of_wide_characters(spark, library):
    wide = "\U00020000" * 64
    df = spark.createDataFrame([(1, wide), (2, wide + " " + wide)], "doc_id bigint, text string")
    out = {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, PATH).collect()}
    assert out == {k: len(library.encode(t, add_special_tokens=False).ids) for k, t in ((1, wide), (2, wide + " " + wide))}


def test_bpe_blanks_beside_white_space(library):
    codec = bpe.Codec(*bpe.load_tokenizer(PATH))
    for text in ("a  b", "a \n b", "a\n b", " a", "a ", "a\u2003 b", "a \u200b b", "a b c", "x\x1c y", "a\u180e b", "", " ", "a \ufeff b"):
        assert struct.unpack(f"<{len(codec.encode(text)) // 4}I", codec.encode(text)) == tuple(library.encode(text, add_special_tokens=False).ids), text


def test_line_dedup_by_text_ids(spark):
    lines = "a b\nc d\ne f"
    rows = [("x", "1\n" + lines), ("b", lines + "\n2"), (None, lines)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    out = {r.doc_id: r.text for r in line_dedup.line_dedup(df).collect()}
    assert out == {"b": lines + "\n2", "x": "1", None: ""}
    large = spark.createDataFrame([((1 << 63) - 1, lines), (None, lines)], "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in line_dedup.line_dedup(large).collect()} == {(1 << 63) - 1: lines, None: ""}


def test_foreign_elements():
    def texts(page):
        return [b.text for b in html_extract.blocks(page)]

    assert texts("<body><svg/><p>a</p><p>b</p></body>") == ["a", "b"]
    assert texts("<div><svg class='i'/>x</div><div>y</div>") == ["x", "y"]
    assert texts("<p>a<svg><path/><text>t</text></svg>b</p>") == ["ab"]
    assert texts("<p>a<template><p>b</template><p>c") == ["a", "c"]


def test_classifier_sample_does_not_depend_on_order(spark, docs):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    twice = docs.union(docs.withColumn("text", F.concat(F.lit("another "), "text")))
    one = quality_classifier.fit(twice.repartition(7), labels)
    two = quality_classifier.fit(twice.repartition(3, "text"), labels.union(labels))
    assert one == two


# --- duplicates -----------------------------------------------------------------------------


def test_exact_dedup(odd, none, docs):
    for df, size in ((odd, 16), (odd, 4096), (docs, 64)):
        rows = [(r.doc_id, re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")) for r in df.collect()]
        groups = {}
        for doc_id, text in rows:
            groups.setdefault(text, []).append(doc_id)
        carry = {"sha": bpe.digest(F.col("content"))}
        got = exact_dedup.exact_dedup(df, carry=carry, block_bytes=size).collect()
        first = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
        want = [(i, first[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows]
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.sha) for r in got), key=key) == sorted(want, key=key)
        assert sum(r.kept for r in got) == len(groups)
        assert all(r.kept == (r.doc_id == r.keep_id) for r in got if r.group_size == 1)
    assert exact_dedup.exact_dedup(none).count() == 0


def _plain_lines(rows):
    """Windows in order of document and place; each later one removes its lines."""
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0], r[1] or "")):
        lines = None if text is None else text.split("\n")
        gone = set()
        for k in range(len(lines or []) - 2):
            window = tuple(lines[k : k + 3])
            if not "".join(window).strip(" \t\n\r\x0b\x0c"):
                continue
            if window in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(window)
        out[doc_id, text] = text if not gone else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_line_dedup(odd, none, docs):
    for df in (odd, docs):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        want = _plain_lines(rows)
        out = line_dedup.line_dedup(df)
        assert set(df.columns) <= set(out.columns)
        assert sorted(((r.doc_id, r.text) for r in out.collect()), key=key) == sorted(((r[0], want[r]) for r in rows), key=key)
    assert line_dedup.line_dedup(none).count() == 0


def _sets(rows, width=3):
    out = []
    for text in rows:
        words = (text or "").encode().lower().split()
        n = min(width, len(words))
        out.append({tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set())
    return out


def _plain_components(ids, texts, width=3, similarity=(9, 10)):
    (num, den), sets, parent = similarity, _sets(texts, width), list(range(len(ids)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and den * min(len(x), len(y)) >= num * max(len(x), len(y)) and den * len(x & y) >= num * len(x | y):
                parent[find(a)] = find(b)
    first = {}
    for k, i in enumerate(ids):
        if i is not None:
            first[find(k)] = min(i, first.get(find(k), i))
    return sorted(((i, len(sets[k]), first.get(find(k))) for k, i in enumerate(ids)), key=key)


def _near_copies(spark, count, seed):
    """A large group of near copies around one text, some just too far, and a common passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base, passage = [word() for _ in range(120)], [word() for _ in range(30)]
    rows = []
    for k in range(count):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = word()
        rows.append((k, " ".join(words)))
    rows += [(count + k, " ".join([*passage, *(word() for _ in range(rng.randint(3, 40)))])) for k in range(count)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_ngram_components(spark, odd, none, docs):
    for df in (odd, docs, _near_copies(spark, 60, 1)):
        rows = df.select("doc_id", "text").collect()
        want = _plain_components([r.doc_id for r in rows], [r.text for r in rows])
        got = ngram_join.ngram_components(df).collect()
        assert sorted((tuple(r) for r in got), key=key) == want
    assert ngram_join.ngram_components(none).count() == 0


def _bridged(seed, small=81, large=119):
    """Two groups of near copies with one passage in common; only the first text of each is like the other's."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base, other = [word() for _ in range(120)], [word() for _ in range(3)]
    cores = [base] * small + [[*base[:60], *other, *base[63:]]] * large
    return [" ".join([*core, *(word() for _ in range(1 if k in (0, small) else 2))]) for k, core in enumerate(cores)]


def test_link_between_large_groups(spark):
    """The only link is found though another component becomes the largest before its partners meet."""
    rows = list(enumerate(_bridged(89)))
    want = _plain_components(*zip(*rows, strict=True))
    assert {c for _, _, c in want} == {0}
    got = ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((tuple(r) for r in got), key=key) == want


def test_later_rounds_look_up_only_nodes_outside(spark, monkeypatch):
    """Nodes of a group's largest component take its label by group; only the others are looked up by node."""
    looked, met, plain, more = [], [], ngram_join._looked_up, ngram_join._more_pairs
    monkeypatch.setattr(ngram_join, "_looked_up", lambda rows, labels: looked.append(rows.count()) or plain(rows, labels))
    monkeypatch.setattr(ngram_join, "_more_pairs", lambda rows, *rest: met.append(rows.count()) or more(rows, *rest))
    docs = spark.createDataFrame(list(enumerate(_bridged(89))), "doc_id bigint, text string")
    assert {r.component_id for r in ngram_join.ngram_components(docs).collect()} == {0}
    assert len(looked) == len(met) > 1 and looked[0] == met[0]
    assert all(x < 0.6 * y for x, y in zip(looked[1:], met[1:], strict=True))


def test_near_copies_meet_in_few_groups(spark, monkeypatch):
    """Near copies of one text share hundreds of signatures; their groups become few, and lose no link."""
    large, plain = [], ngram_join._large
    monkeypatch.setattr(ngram_join, "_large", lambda *args: large.append(plain(*args)) or large[0])
    rows = _near_copies(spark, 60, 1).collect()
    got = ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((tuple(r) for r in got), key=key) == _plain_components(*zip(*rows, strict=True))
    assert large[0].count() <= 8 * large[0].select("node").distinct().count()


def test_groups_that_overlap_become_one(spark):
    """No pair of nodes is lost, and groups that share little stay as they are."""
    rng = random.Random(4)
    alike = {100 + k: {0, *rng.sample(range(1, 60), 50)} for k in range(9)}
    apart = {200 + k: {-1, *range(1000 * k + 1000, 1000 * k + 1040)} for k in range(5)}
    groups = alike | apart | {300: {-2, *range(20)}}
    rows = [(sig, node, 70, len(nodes), min(nodes)) for sig, nodes in groups.items() for node in nodes]
    merged = {}
    for r in ngram_join._merged(spark.createDataFrame(rows, "sig bigint, node bigint, n bigint, c bigint, hub bigint")).collect():
        merged.setdefault((r.sig, r.c), []).append(r.node)
    assert all(len(nodes) == len(set(nodes)) == c for (_, c), nodes in merged.items())
    whole = [set.union(*alike.values()), *apart.values(), groups[300]]
    assert sorted(map(sorted, merged.values())) == sorted(map(sorted, whole))


def test_one_of_each(odd, docs):
    got = ngram_join.one_of_each(odd)
    assert got.columns == odd.columns
    assert sorted([r.doc_id for r in got.collect()], key=str) == sorted([1, 3, 4, None, 5, 7, 9, 10, 11, 12, 13], key=str)
    want = [r.doc_id for r in ngram_join.ngram_components(docs).collect() if r.doc_id == r.component_id]
    assert sorted(r.doc_id for r in ngram_join.one_of_each(docs).collect()) == sorted(want)


def test_signatures_lose_no_similar_pair():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(2, 400))
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        gone = rng.random(len(x)) < rng.choice([0.0, 0.03, 0.05])
        y = np.unique(np.concatenate([x[~gone], rng.integers(0, 1 << 63, int(0.04 * n)).astype(np.uint64)]))
        common = len(np.intersect1d(x, y))
        if 100 * common < 90 * (len(x) + len(y) - common) or np.array_equal(x, y):
            continue
        often = rng.choice([0.0, 0.5, 0.95, 1.0])
        frequent = np.unique(np.union1d(x, y)[rng.random(len(np.union1d(x, y))) < often] >> np.uint64(24))
        (a, _, c, wide), (b, _, d, wide2) = (ngram_join.signatures(s, frequent) for s in (x, y))
        beside = np.intersect1d(c, d) if wide or wide2 else np.empty(0)
        assert len(np.intersect1d(a, b)) or len(beside)
        assert ngram_join.parity_distance(ngram_join.parity_bits(x), ngram_join.parity_bits(y)) <= len(np.setxor1d(x, y))


def test_rounds_let_go_of_finished_steps(spark, monkeypatch):
    from tidemark.llm import components as module

    rounds, released = [], []
    monkeypatch.setattr(module, "stored", lambda df, what, kept=module.stored: rounds.append(what) or kept(df, what))
    monkeypatch.setattr(module, "release", released.append)
    path = spark.createDataFrame([(k, k + 1) for k in range(20)], "a bigint, b bigint")
    assert {tuple(r) for r in module.components(path).collect()} == {(k, 0) for k in range(21)}
    assert len(rounds) > 1 and len(released) == len(rounds)


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {x: find(x) for x in parent}


# --- quality --------------------------------------------------------------------------------


def test_quality_rules(spark, odd, none):
    got = {(r.doc_id, r.n_words): r for r in quality_rules.quality_rules(odd).collect()}
    assert got[1, 12].kept and not got[1, 12].base_failed
    assert got[3, 0].base_failed and got[4, 0].base_failed
    assert got[5, 60_001].n_repeat_words == 60_000
    assert quality_rules.quality_rules(none).count() == 0
    for words in ([], ["a"] * 6, list("abcdeabcde"), list("abcdefgabcdxx"), list("xabcdeyabcdez")):
        spans = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        covered = {k + j for k, s in enumerate(spans) if spans.count(s) > 1 for j in range(5)}
        assert quality_rules.repeated_words([w.encode() for w in words]) == len(covered)
    # a host of failing documents loses the good one, a host with one failure does not
    good = " ".join(f"w{k}" for k in range(30))
    bad = "# $ " * 10
    rows = [(k, bad, "bad") for k in range(40)] + [(50, good, "bad")] + [(100 + k, good, "good") for k in range(60)] + [(200, bad, "good")]
    out = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    kept = {r.doc_id: r.kept for r in out.collect()}
    assert not kept[50] and kept[100]


def test_quality_classifier(spark, odd, none):
    docs, labels = (spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    scores = {r.doc_id: r for r in quality_classifier.quality_scores(docs, labels).collect()}
    known = {r.doc_id: r.quality for r in labels.collect()}
    out = [i for i in known if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(scores[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in scores)
    right = [scores[i].predicted == known[i] for i in out]
    assert len(out) > 50 and sum(right) / len(right) >= 0.97
    model = quality_classifier.fit(docs, labels)
    odd_scores = quality_classifier.score(odd, model).collect()
    assert len(odd_scores) == len(ODD) and all(0 <= r.score <= 1 for r in odd_scores)
    assert quality_classifier.accepted(odd, model).columns == odd.columns
    empty = quality_classifier.quality_scores(none, labels.limit(0))
    assert empty.count() == 0
    assert [r.score for r in quality_classifier.quality_scores(odd, labels.limit(0)).collect()] == [0.5] * len(ODD)


# --- licences, mix, pages -------------------------------------------------------------------


def test_license_scan(spark, none, odd):
    rng = random.Random(6)
    names = list(license_scan.TEMPLATES)
    rows, want = [], set()
    for k in range(200):
        words = ["".join(rng.choice("mnopqr") for _ in range(5)) for _ in range(rng.randint(0, 300))]
        for nth, name in enumerate(rng.sample(names, rng.randint(0, 2))):
            if {name, *(w for i, w in want if i == k)} >= {"apache-2.0", "apache-2.0-header"}:
                continue
            at = len(words) if nth else rng.randint(0, len(words))
            words[at:at] = license_scan.TEMPLATES[name].upper().split() + ["zz"]
            want.add((k, name))
        rows.append((k, " ".join(words)))
    got = {(r.doc_id, r.license) for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert want <= got and all(name == "apache-2.0" for _, name in got - want)
    assert license_scan.license_scan(none).count() == 0 and license_scan.license_scan(odd).count() == 0
    for n in (1, 3, 40, 500):
        share = -(-4 * n // 5) / (2 * 2 ** license_scan.template_class(n) + n - -(-4 * n // 5))
        assert (1 - share) ** license_scan.bands_for(n) <= 1e-6


def windows_by_brute_force(templates, text):
    """``license, share, first word`` of the best window, all windows compared."""

    def shingles(t):
        words = re.findall(r"[a-z0-9]+", t.lower())
        return [tuple(words[k : k + 5]) for k in range(len(words) - 4)]

    grams, out = shingles(text), set()
    for name, template in templates.items():
        wanted = set(shingles(template))
        step = 1 << license_scan.template_class(len(wanted))
        halves = -(-len(grams) // step)
        shares = [(len(wanted & set(grams[k * step : (k + 2) * step])) / len(wanted), -k * step) for k in range(max(halves - 1, min(halves, 1)))]
        if shares and max(shares)[0] >= license_scan.CONTAINED:
            out.add((name, *max(shares)))
    return {(name, share, -start) for name, share, start in out}


def test_whole_licence_texts(spark):
    """Whole, cut, edited and joined licence texts in other words, held against every window."""
    rng, texts = random.Random(8), license_scan.built_in()
    whole = {name: text.split() for name, text in texts.items() if name.endswith("-text")}
    assert len(whole) >= 16

    def other(n):
        return ["".join(rng.choice("mnopqr") for _ in range(5)) for _ in range(n)]

    rows = []
    for words in whole.values():
        n = len(words)
        edited = [w if rng.random() > 0.01 else "zz" for w in words]
        for body in (words, words[: int(n * 0.9)], words[: int(n * 0.6)], edited, [w.upper() for w in words]):
            rows.append(" ".join(other(rng.randint(0, 3000)) + body + other(rng.randint(0, 500))))
    rows += [" ".join(whole["mit-text"] + other(40) + whole["gpl-3-text"] + other(9) + whole["bsd-text"]), *[" ".join(other(k)) for k in (0, 4, 5, 700)]]
    out = license_scan.license_scan(spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")).collect()
    got = {}
    for r in out:
        got.setdefault(r.doc_id, set()).add((r.license, r.contained, r.first_word))
    assert got == {k: found for k, t in enumerate(rows) if (found := windows_by_brute_force(texts, t))}
    for k, name in enumerate(whole):
        assert name in {x[0] for x in got[5 * k]} and name in {x[0] for x in got[5 * k + 1]}


def test_source_mix(spark, odd, none, docs):
    for df in (docs, odd):
        out = source_mix.mix_plan(df).collect()
        assert len(out) == df.count() and all(0 <= r.taken <= 3 * r.size for r in out)
        assert sorted(map(str, out)) == sorted(map(str, source_mix.mix_plan(df).collect()))
        sources = {}
        for r in out:
            s = sources.setdefault(r.source, [0, r.target, 0, 0])
            s[0] += r.size
            s[2] += r.taken
            s[3] = max(s[3], r.size)
        total = sum(s[0] for s in sources.values())
        assert abs(sum(s[1] for s in sources.values()) - total) < 1e-6 * total + 1e-9
        assert all(abs(s[2] - s[1]) <= max(s[3], 0.02 * s[1]) for s in sources.values())
        taken = sum(len(r.draws or []) for r in out)
        assert source_mix.mixed(df).count() == taken and source_mix.mixed(df).columns == df.columns
    assert source_mix.mix_plan(none).count() == 0 and source_mix.mixed(none).count() == 0


def _mix_targets(spark, sizes, weights=source_mix.WEIGHTS):
    sources = spark.createDataFrame(list(enumerate(sizes)), "no bigint, source_size bigint")
    return [r.target for r in source_mix.with_targets(sources, weights).orderBy("no").collect()]


def _plain_targets(sizes, weights):
    """Shares by weight, lowered one source at a time, the one most over its limit first."""
    weight = {k: weights[k % len(weights)] for k in range(len(sizes))}
    out, left = {}, Fraction(sum(sizes))
    while len(out) < len(sizes):
        rest = sum(weight[k] for k in weight if k not in out)
        share = {k: left * weight[k] / rest for k in weight if k not in out}
        worst = max(share, key=lambda k: share[k] - 3 * sizes[k])
        if share[worst] <= 3 * sizes[worst]:
            return [float(out.get(k, share.get(k))) for k in weight]
        out[worst] = Fraction(3 * sizes[worst])
        left -= out[worst]
    return [float(out[k]) for k in weight]


def test_mix_targets(spark):
    assert _mix_targets(spark, [100, 100, 100]) == [187.5, 75.0, 37.5]
    assert _mix_targets(spark, [10, 100, 100]) == [30.0, 120.0, 60.0]
    assert _mix_targets(spark, []) == [] and _mix_targets(spark, [0, 0]) == [0.0, 0.0]
    rng = random.Random(8)
    for weights in ((5, 2, 1), (1,), (7, 1, 3, 90)):
        # sizes far apart, so that sources reach their limits one after the other
        sizes = [int(2 ** rng.uniform(0, 30)) if rng.random() > 0.1 else 0 for _ in range(40)]
        assert _mix_targets(spark, sizes, weights) == pytest.approx(_plain_targets(sizes, weights), rel=1e-12)


def test_mix_of_many_sources(spark, monkeypatch):
    """Names beyond the size to broadcast, in groups split by tasks; a third of all documents in one source."""
    rows = [(k, "w " * (k % 7), "hot" if k % 3 == 0 else None if k % 500 == 1 else f"site{k % 901}.example") for k in range(6000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    whole = {r.doc_id: (r.size, r.source_size, r.target, r.taken) for r in source_mix.mix_plan(df).collect()}
    monkeypatch.setattr(source_mix, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(source_mix, "HOT_PART", 100)
    monkeypatch.setattr(source_mix, "GROUP", 32)
    out = source_mix.mix_plan(df).collect()
    assert {r.doc_id: (r.size, r.source_size, r.target, r.taken) for r in out} == whole and len(out) == len(rows)
    names = sorted({r[2] for r in rows if r[2]}, key=lambda n: n.encode()) + [None]
    sizes = [0] * len(names)
    for _, text, name in rows:
        sizes[names.index(name)] += len(text.split())
    assert {r.source: r.source_size for r in out} == dict(zip(names, sizes))
    plain = dict(zip(names, _plain_targets(sizes, source_mix.WEIGHTS)))
    assert all(r.target == pytest.approx(plain[r.source], rel=1e-12) for r in out)


def test_shards_of_many_sources(spark, monkeypatch):
    monkeypatch.setattr(source_mix, "GROUP", 32)
    rng = random.Random(9)
    count = {k: rng.choice((0, 1, 2, 40)) for k in range(500)}
    drawn = spark.createDataFrame([(k, j) for k, n in count.items() for j in range(n)], "no bigint, place bigint")
    ends = {r.no: r.ends for r in source_mix._shard_ends(drawn, len(count), 7, 1).collect()}
    assert {k: e[-1] for k, e in ends.items()} == {k: n for k, n in count.items() if n}
    assert all(e == sorted(e) and len(e) == 7 for e in ends.values())
    shards = np.diff(np.array([[0, *e] for e in ends.values()]), axis=1).sum(axis=0)
    assert shards.max() - shards.min() <= 2


def test_split_tree():
    draws = np.array([0, 5, 1000, 77])
    split = source_mix.split_tree(draws, 7, 1)
    assert (split.sum(axis=0) == draws).all() and (split >= 0).all()
    assert split.sum(axis=1).max() - split.sum(axis=1).min() <= 2


def _article(page):
    """Text of the one article of a test page."""
    body = re.search(r"<article>(.*?)(</article>|$)", page, re.S).group(1)
    parts = [" ".join(html.unescape(re.sub(r"</?b>", "", re.sub("<br>", " ", p))).split()) for p in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(p for p in parts if p)


def test_html_extract(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r.page_id: r for r in html_extract.html_extract(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == _article(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text)
    odd = [(1, None, None), (2, "u", ""), (3, "u", "<p"), (4, None, "<div>" * 3000 + "x"), (4, None, "</p></p><nav>a</nav><script>if (a<b) '</p>'")]
    odd.append((5, "u", "<main>" + "<p>one &amp; two&nbsp;three</p>" * 2000 + "</main>"))
    out = html_extract.html_extract(spark.createDataFrame(odd, "page_id bigint, url string, html string").withColumn("text", F.lit(1)))
    rows = sorted(out.collect(), key=lambda r: r.page_id)
    assert len(rows) == 6 and rows[0].text == rows[1].text == "" and "one & two three" in rows[-1].text
    assert html_extract.html_extract(pages.limit(0)).count() == 0


def test_page_without_end_of_head(spark):
    pages = [r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    model = html_extract.trained()
    for page in pages:
        assert "</head>" in page
        assert html_extract.extract(page.replace("</head>", ""), model) == _article(page)
    head = "<html><head><meta charset=x><title>t</title><script>s</script><style>y</style><noscript><p>n</p></noscript>"
    for rest in ("<body><p>a</p><p>b", "<p>a</p><p>b", "a<p>b", "<head><body>a<p>b", "</head><body>a<p>b", "</head>a<p>b"):
        assert [b.text for b in html_extract.blocks(head + rest)] == ["a", "b"]
    assert html_extract.blocks(head) == html_extract.blocks(head + " \n</head> </html>") == []


def test_labeller_on_other_layouts():
    made = training_pages(200, 77)
    found = html_extract.trained().main([p for p, _ in made])
    wrong = sum(int((f != (y > 0.5)).sum()) for f, (_, y) in zip(found, made, strict=True))
    assert wrong <= 0.01 * sum(len(p) for p, _ in made)


# --- pipeline -------------------------------------------------------------------------------


def test_pipeline(spark, docs):
    """Each stage against what its operator decides, on what the one before it kept."""
    now, last = docs, [r.asDict() for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, DATA)
        rows = [r.asDict() for r in out.collect()]
        if name != "bpe":
            assert out.columns == docs.columns
        if name == "quality classifier":
            model = quality_classifier.fit(now, spark.read.parquet(f"{DATA}/labels.parquet"))
            get = quality_classifier.Words(model.contribution, 1000).__getitem__
            want = [r["doc_id"] for r in last if model.odds(r["text"], get) >= 0]
            assert sorted(r["doc_id"] for r in rows) == sorted(want)
        elif name == "line dedup":
            plain = _plain_lines([(r["doc_id"], r["text"]) for r in last])
            assert {(r["doc_id"], r["text"]) for r in rows} == {(i, t) for (i, _), t in plain.items()}
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        elif name == "n-gram join":
            plain = _plain_components([r["doc_id"] for r in last], [r["text"] for r in last], 5, (4, 5))
            assert sorted(r["doc_id"] for r in rows) == sorted(i for i, _, c in plain if i == c)
            # at op 8's own setting near copies would stay
            assert len(rows) < sum(i == c for i, _, c in _plain_components([r["doc_id"] for r in last], [r["text"] for r in last]))
        elif name == "source mix":
            size = {r["doc_id"]: len(r["text"].split()) for r in last}
            total = {r["source"]: 0 for r in last}
            for r in rows:
                total[r["source"]] += size[r["doc_id"]]
            assert sum(total.values()) == pytest.approx(sum(size.values()), rel=0.02)
        else:
            library = Tokenizer.from_file(PATH)
            text = {r["doc_id"]: r["text"] for r in last}
            assert len(rows) == len(last)
            for r in rows:
                ids = library.encode(text[r["doc_id"]], add_special_tokens=False).ids
                assert bytes(r["ids"]) == struct.pack(f"<{len(ids)}I", *ids)
                assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()
        now, last = out, rows


def test_pipeline_on_no_rows(spark, none):
    now = none
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, DATA)
        assert now.count() == 0


def test_shared_folder_is_named_on_a_cluster():
    def of(master, **conf):
        conf = {"spark.sql.warehouse.dir": "/warehouse", **{k.replace("_", "."): v for k, v in conf.items()}}
        return FakeSession(SimpleNamespace(get=lambda key, default=None: conf.get(key, default)), SimpleNamespace(master=master))

    FakeSession = namedtuple("FakeSession", "conf sparkContext")
    assert shared_folder(of("spark://host:7077", spark_checkpoint_dir="s3a://shared/steps")) == "s3a://shared/steps"
    assert shared_folder(of("local[8]")) == "/warehouse/_steps"
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="checkpoint"):
            shared_folder(of(master))
