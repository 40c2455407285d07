"""Line dedup, token alignment and source divergence against brute force; long texts of the other operators."""

import hashlib
import random
import re
import resource
import sys
import tempfile
import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
from test_llm_operators import LOWER, docs_of, empty

from lattica.llm import alignment, decontaminate, divergence, licenses, linedup, packing, toxicity
from lattica.llm.common import alnum_words, word_parts
from lattica.session import ship

BLANKS = " \t\n\x0b\x0c\r"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


# 11


def brute_lines(rows):
    owner = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(BLANKS).translate(LOWER)
            if len(key) >= 10:
                rank = (i is None, i or 0)
                owner[key] = min(owner.get(key, rank), rank)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(k := x.strip(BLANKS).translate(LOWER)) < 10 or owner[k] == (i is None, i or 0)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def line_rows():
    rng = random.Random(11)
    pool = ["a line of some length", "  A Line of some LENGTH\t", "short", "", "ten chars!", "nine char", "É é É é É é", "É é É é É é ", "x" * 50, " padded with no-break ", "carriage return\r", "carriage return"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randrange(7)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "\n\n"), (None, pool[0] + "\n" + "only in the null row"), (None, "only in the null row"), (5, pool[0]), (5, pool[0]), (63, "repeats within one\nrepeats within one"), (64, "x" * 50 + "\n" + "line of a long text\n" * 3000)]
    return rows


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_line_dedup(spark, batches):
    rows = line_rows()
    docs = docs_of(spark, [t for _, t in rows], [i for i, _ in rows], n_lines="clash", places="kept", lines=1)
    got = linedup.without_repeated_lines(docs, batches=batches, fanout=2)
    assert got.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got.collect()), key=str) == brute_lines(rows)
    assert {r.places for r in got.collect()} == {"kept"} and got.filter("text is null").count() == 1
    assert linedup.without_repeated_lines(empty(docs)).count() == 0


def test_line_report(spark):
    rows = line_rows()
    got = linedup.line_report(docs_of(spark, [t for _, t in rows], [i for i, _ in rows]))
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute_lines(rows)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    named = spark.createDataFrame([("b", "one line of text"), ("a", "one line of text"), ("c", "another line here")], "doc_id string, text string")
    assert sorted((r.doc_id, r.n_dropped) for r in linedup.line_report(named).collect()) == [("a", 0), ("b", 1), ("c", 0)]


def test_line_runs(spark):
    """Batches that arrive one by one: runs share no hash, levels hold fewer runs than the fan-out, and what is found to be
    dropped is what a set of all keys so far says."""
    rng = random.Random(3)
    runs, seen = linedup.LineRuns(spark, fanout=3, buckets=4), set()
    for b in range(8):
        rows = [(b * 100 + i, rng.randrange(60)) for i in range(30)]
        lines = spark.createDataFrame([(d, k, k * 7) for d, k in rows], "doc_id long, h1 long, h2 long")
        got = sorted((r.doc_id, r.h1) for r in runs.added(lines).collect())
        first = {k: min(d for d, x in rows if x == k) for _, k in rows}
        assert got == sorted((d, k) for d, k in rows if k in seen or d != first[k])
        seen |= {k for _, k in rows}
        held = [r.h1 for level in runs.levels for name in level for r in spark.table(name).collect()]
        assert sorted(held) == sorted(seen) and all(len(level) <= 3 for level in runs.levels)
    assert len(runs.levels) > 1
    runs.clear()
    assert not runs.paths and not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


# 12


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(alignment.BYTE_VOCABULARY)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_MODEL), alignment.byte_level()


def brute_groups(sides, text):
    """Tokens of both sides and the groups between common ends; None without tokens."""
    a, b, alphabet = sides
    if not text:
        return None
    raw, x, y = b" " + text.encode(), a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    left = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in x]
    right = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in y for p in [b.id_to_piece(i)]]
    if b"".join(left) != raw or b"".join(right) != raw:
        return None
    ends = [np.cumsum([len(t) for t in side]).tolist() for side in (left, right)]
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        p, q = ends[0].index(cut) + 1, ends[1].index(cut) + 1
        groups.append((x[i:p], y[j:q]))
        i, j = p, q
    return x, y, groups


TEXTS = [
    None, "", " ", "  ", "\n", " a", "a ", "a  b", "x▁y", "a b▁ c", "é x é", "😀 👩‍👩‍👧 ok", "<|endoftext|> <s> </s> <unk> <0x41>", "日本語 の 文章", "\x00 a", "a　b c", "don't  it's", "\t\tfoo\tbar", "a" * 400, " " * 300 + "x",
    "foo." * 100, "ﬁ ſ Ⅷ ½", "a\x1cb \x1c c", "the quick brown fox", "The quick brown fox.\nJumps over", "the the the", "===== ----", "dup text here", "dup text here", "x " * 2000,
]


def test_aligner(sides, monkeypatch):
    """Tokens, groups, digests and links of every text, whatever is held at once."""
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice(["a", "b", " ", "  ", "\n", "é", "the", "▁", "1", ".", "'s", "日", "😀", " of", "\t", "<s>"]) for _ in range(rng.randrange(40))) for _ in range(200)]
    files = [Path(f).read_bytes() for f in (alignment.BYTE_VOCABULARY, alignment.PIECE_MODEL)]
    found = []
    for small in (False, True):
        if small:
            for name, value in (("SPLIT_CHARS", 40), ("EXPANDED", 50), ("KEPT_CHUNKS", 40), ("PLAIN_PAIRS", 3)):
                monkeypatch.setattr(alignment, name, value)
        aligner = alignment.Aligner(*files)
        assert aligner.splits
        found.append(aligner.aligned(texts))
    (totals, digests, keys, times), again = found
    assert (totals == again[0]).all() and digests == again[1] and (keys == again[2]).all() and (times == again[3]).all()
    links = defaultdict(Counter)
    for key, n in zip(keys.tolist(), times.tolist(), strict=True):
        stripe, at = divmod(key >> alignment.DOC_BITS, aligner.width)
        links[key & ((1 << alignment.DOC_BITS) - 1)][at // aligner.n_b * aligner.stripes + stripe, at % aligner.n_b] = n
    for d, text in enumerate(texts):
        got = brute_groups(sides, text)
        if got is None:
            assert not totals[d].any() and digests[d] == "" and not links[d]
            continue
        x, y, groups = got
        line = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        want = Counter((a, b) for p, q in groups for a in p for b in q)
        assert totals[d].tolist() == [len(x), len(y), len(groups), want.total()] and links[d] == want
        assert digests[d] == hashlib.sha256(line.encode()).hexdigest()


def test_alignment(spark, sides, monkeypatch):
    docs = docs_of(spark, TEXTS, n_best="clash").repartition(5)
    per = {i: Counter((a, b) for p, q in (brute_groups(sides, t) or ([], [], []))[2] for a in p for b in q) for i, t in enumerate(TEXTS)}
    counts, top = Counter(k for c in per.values() for k in c), {}
    for (a, _), n in counts.items():
        top[a] = max(top.get(a, 0), n)
    for fan in (1024, 2):  # one level of sums, and several
        monkeypatch.setattr(alignment, "FAN", fan)
        got = {r.doc_id: r for r in alignment.alignment(docs, stripes=150).collect()}
        assert set(got) == set(per)
        for i, c in per.items():
            assert (got[i].n_links, got[i].count_sum) == (c.total(), sum(n * counts[k] for k, n in c.items()))
            assert got[i].n_best == sum(n for k, n in c.items() if counts[k] == top[k[0]])
    assert {tuple(r) for r in alignment.token_map(docs).collect()} == {(a, b, n) for (a, b), n in counts.items() if n == top[a]}
    assert alignment.alignment(empty(docs)).count() == 0 and alignment.token_map(empty(docs)).count() == 0


# 13


def brute_divergence(rows, least, top):
    """(lang, source, part, item, value, rank) by loops over all terms."""
    per, docs = defaultdict(lambda: defaultdict(Counter)), defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        per[lang or ""][source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    f = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for lang, sources in per.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        v = len(kept)

        def chances(counts, kept=kept, v=v):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * v) for t in kept}

        whole, each = chances(sum(sources.values(), Counter())), {s: chances(c) for s, c in sources.items()}
        for s, p in each.items():
            pairs = [(sum(f(p[t], q[t]) for t in kept), o) for o, q in each.items() if o != s]
            terms = [(f(p[t], whole[t]), t) for t in kept if sources[s][t] > 0 and p[t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [64, 2])
def test_divergence(spark, block):
    rng = random.Random(13)
    terms = [f"t{chr(97 + i)}" for i in range(20)] + ["É", "日本", "A1b", "x_y", "Ünï"]
    rows = [(" ".join(rng.choices(terms, k=rng.randrange(30))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "É", "s5", None])) for _ in range(150)]
    rows += [(None, "xx", "lone"), ("", "en", "empty"), ("12 34", "de", None), ("rare words here", "yy", "a"), ("rare words here", "yy", "b"), ("tb " * 30_000, "en", "s1"), *[("dup text here", "en", "s2")] * 3]
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({"n": F.lit("clash"), "term": F.lit(1)}).repartition(4)
    assert sorted(map(tuple, divergence.audited(df, least=4, top=3, block=block, stripe=5 if block == 2 else 4096).collect())) == brute_divergence(rows, 4, 3)
    assert divergence.audited(empty(df)).count() == 0


# long texts of the others


def test_word_parts():
    text = ("Ab-c é9 " * 1000 + "x" * 500).encode()
    for limit in (1, 7, 100, 1 << 20):
        assert [w for part in word_parts(text, limit=limit) for w in part] == alnum_words(text)
    assert list(word_parts(None)) == list(word_parts(b"")) == []


def test_long_white_space():
    """Padded tables in linear time, with the ids of the pattern."""
    codec = packing.encoding()
    for run in (1000, 32_000, 65_535, 70_000):
        text = ("x" + " " * run) * (2_000_000 // run)
        began = time.time()
        ids = packing.token_ids(codec, text)
        assert time.time() - began < 5 and codec.decode(ids) == text
    for text in ("q" + " " * 300 + "z" + "\n" * 100, "　" * 50 + "a" + "\t" * 30 + " b"):
        assert packing.token_ids(codec, text, long_run=20) == codec.encode_ordinary(text)


def matches(ids, items, window):
    with tempfile.NamedTemporaryFile(delete=False) as f:
        f.write(decontaminate.TestBlock.built(items, window))
    block, shard, at, group = decontaminate.TestBlock.mapped(f.name), decontaminate.Shard(ids, 20, window, window), [], []
    for numbers, columns, widths in block.windows():
        a, w = shard.found(columns, widths)
        at.append(a)
        group.append(numbers[w])
    at, group = np.concatenate(at), np.concatenate(group)
    whole = group < len(block.groups)
    order = np.argsort(at[whole], kind="stable")
    at, group = at[whole][order], group[whole][order]
    began = time.time()
    length, place = block.longest(ids, at, group)
    return at, length, place, block, time.time() - began


def test_longest_matches(monkeypatch):
    monkeypatch.setattr(decontaminate, "STRIDES", (4, 16, 64))
    rng = random.Random(0)
    for _ in range(40):
        k = rng.choice([1, 2, 3, 20])
        items = [(str(i), [rng.randrange(1, k + 2) for _ in range(rng.randrange(1, 90))]) for i in range(rng.randrange(1, 6))]
        ids = []
        for _ in range(rng.randrange(1, 5)):
            item = rng.choice(items)[1]
            ids += item[rng.randrange(len(item)) :] + [rng.randrange(0, k + 2) for _ in range(rng.randrange(3))] + [0]
        at, length, place, block, _ = matches(np.array([*ids, 0]), items, 3)
        for p, s, n in zip(at.tolist(), place.tolist(), length.tolist(), strict=True):
            best = 0
            for _, item in items:
                for q in range(len(item)):
                    m = 0
                    while p + m < len(ids) and q + m < len(item) and ids[p + m] == item[q + m]:
                        m += 1
                    best = max(best, m)
            assert n == best and (np.array(ids[p : p + n]) == block.flat[s : s + n]).all()


def test_long_copy():
    """A verbatim copy of 100,000 words in a few seconds; half of it is an item of its own."""
    rng = random.Random(1)
    item = [rng.randrange(1, 50_000) for _ in range(100_000)]
    at, length, _, _, took = matches(np.array([*item, 0]), [("a", item), ("b", item[:50_000])], 13)
    assert took < 5 and (length == 100_000 - at).all()


def test_repeated_benchmark_rows(spark):
    words = " ".join(f"w{i}" for i in range(40))
    bench = spark.createDataFrame([("i", words)] * 50 + [("j", words)], "item_id string, text string")
    row = decontaminate.marked(docs_of(spark, [words]), bench).first()
    assert (row.n_hit, row.n_items, row.longest_match) == (40, 2, 40)


def grown(run, most_mb):
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    run()
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < most_mb << 10


def test_license_long_texts():
    """Long texts give what short ones do, and 50 MB of one word take little memory."""
    index, rng = licenses.RareTokenIndex(licenses.TEMPLATES, 100, {}), random.Random(5)
    for _ in range(60):
        words = []
        for _ in range(rng.randrange(1, 6)):
            of = alnum_words(rng.choice(licenses.TEMPLATES).text.encode())
            start = rng.randrange(len(of))
            words += of[start : start + rng.randrange(1, 60)] + [b"zz"] * rng.randrange(3)
        plain = lambda found: {k: sorted((p, round(s, 9)) for p, s in x) for k, x in found.items()}
        assert plain(index.places(words)) == plain(index.long_places(index.numbered(b" ".join(words))))
    grown(lambda: index.long_places(index.numbered(b"license " * 6_250_000)), 900)
    held = index.long_places(index.numbered(b"all rights reserved " * 100_000))
    reserved = [k for k, t in enumerate(licenses.TEMPLATES) if t.label == "reserved"]
    assert [p for p, _ in held[reserved[0]]] == list(range(0, 300_000, 3))


def test_toxicity_long_texts(monkeypatch):
    rng = random.Random(6)
    model = toxicity.trained([([b"bad", b"word"] * 5, "en", 1)] * 30 + [([b"good", b"text"] * 5, "de", 0)] * 30)
    for _ in range(40):
        text = " ".join(rng.choice(["bad", "word", "good", "text", "x"]) for _ in range(rng.randrange(300))).encode()
        monkeypatch.setattr(toxicity, "PART_BYTES", rng.choice([3, 20, 50]))
        one, many = toxicity.forward(model, toxicity.Vectors(model), [alnum_words(text)]), toxicity.forward_long(model, toxicity.Vectors(model), text)
        assert np.allclose(one[0], many[0]) and one[1][0] == many[1][0]
    monkeypatch.setattr(toxicity, "PART_BYTES", 1 << 20)
    grown(lambda: toxicity.forward_long(model, toxicity.Vectors(model), b"bad " * 5_000_000), 900)
