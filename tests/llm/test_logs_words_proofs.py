"""Manifest, spelling variants and conversations against plain Python, and against SQL on the driver tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tally.llm import chats, merkle, queries, spelling

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_rows_are_those_of_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = con.sql(queries.SQL[name])
    got = queries.QUERIES[name](spark, SF_DIR)
    assert got.columns == want.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))


# --- manifest


def plain_leaf(*fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def plain_path(levels, at):
    path = []
    for level in levels[:-1]:
        start = at // 16 * 16
        path.append(("".join(level[start:at]), "".join(level[at + 1:start + 16])))
        at //= 16
    return path


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(*r)))
        trees[g] = plain_levels([plain_leaf(*r) for r in groups[g]])
    top = plain_levels([trees[g][-1][0] for g in order])
    root, out = top[-1][0], []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            path, given = plain_path(trees[g], i) + plain_path(top, k), list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                given[4] = lower(r[4])
            h = plain_leaf(*given)
            for a, b in path:
                h = sha(a + h + b)
            out.append((r[0], plain_leaf(*r), trees[g][-1][0], root, sha("".join(a + b for a, b in path)), h, h == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [[1], [16, 1], [17, 256, 2], [257, 4097, 15, *[1] * 20]])
def test_manifest_is_the_plain_one(spark, sizes):
    rnd = random.Random(len(sizes))
    rows = [(1000 * j + i, None if j == 2 else f"é{j}" if j % 2 else f"s{j}", rnd.choice([None, "en"]), rnd.choice([None, 3]), rnd.choice([None, "", "Abc É", "y" * i]))
            for j, n in enumerate(sizes) for i in range(n)]
    rows += [(None, "s0", "en", 1, "A")] * 2 + [(5, "s0", None, None, "B")] * 3
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS + ", leaf int, grp string")  # clashing names
    assert sorted(map(tuple, queries.merkle_rows(df).collect()), key=str) == plain_manifest(rows)


def test_manifest_of_no_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert merkle.manifest(empty, ["doc_id", "text"], "doc_id", "source").root is None
    assert queries.merkle_rows(empty).collect() == []


# --- spelling variants


def plain_variants(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            counts[queries.one_lost(lower(run), lower(run).encode(), zlib.crc32(f"{'' if key is None else key}:".encode()))] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    form, others = {}, {}
    for w in words:
        others[w] = [v for v in words if abs(len(v) - len(w)) < 2 and near(w, v)]
        best = min(others[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n, len(others[w]), words[form[w]] if form[w] else None) for w, n in words.items())


def spelled(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    return sorted(map(tuple, spelling.variants(spelling.word_counts(df, alter=queries.one_lost)).collect()))


@pytest.mark.parametrize("block", [3, 512])
def test_variants_are_the_plain_ones(spark, monkeypatch, block):
    """Chains of forms, ties of frequency, letters beyond ASCII, anagrams, blocks of a few words."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    rnd = random.Random(5)
    stems = ["schreiben", "straße", "éléphant", "letters", "settler", "abcdef", "abcdeg", "bcdefa"]
    pool = []
    for stem in stems:
        pool += [stem] * rnd.choice([30, 150]) + [stem + "s"] * 30
        for _ in range(12):
            i = rnd.randrange(len(stem))
            pool += [rnd.choice([stem[:i] + stem[i + 1:], stem[:i] + rnd.choice("axÀé") + stem[i:], stem[:i] + "q" + stem[i + 1:]])] * rnd.choice([4, 5, 6])
    rnd.shuffle(pool)
    rows = [(k, " ".join(w.capitalize() if rnd.random() < .3 else w for w in pool[k::40])) for k in range(40)]
    rows += [(None, "letters letters"), (1, None), (2, ""), (3, "12 34 !"), rows[0], rows[0], (4, ("z" * 3000 + " ") * 5 + ("z" * 2999 + " ") * 30)]
    got = spelled(spark, rows)
    assert got == plain_variants(rows) and any(r[1] and r[1] != r[2] for r in got)


def test_no_words(spark):
    assert spelled(spark, [(1, None)]) == [] and spelled(spark, [(1, "only short")]) == []


# --- conversations


def replayed(log):
    """The log read event by event."""
    out = defaultdict(list)
    for conv, _, kind, message, role, text in log:
        turns = out[conv]
        at = next((i for i, t in enumerate(turns) if t[0] == message), None)
        if kind == "message":
            turns.append([message, role or "", text or ""])
        elif at is not None:
            if kind == "regenerate":
                del turns[at + 1:]
            turns[at][2] = (turns[at][2] if kind == "delta" else "") + (text or "")
    return {c: [tuple(t[1:]) for t in turns] for c, turns in out.items()}


def test_logs_fold_as_replayed(spark):
    rnd, log = random.Random(11), []
    bits = ["\\", "### ", "</turn>", "\n", "a", "😀", "é", "</turn>\n", "", None]
    for conv in [None, *range(40)]:
        live, made = [], 0
        for seq in range(rnd.randint(1, 60)):
            kind = rnd.choice(["message", "delta", "delta", "delta", "edit", "regenerate"]) if live else "message"
            if kind == "message":
                made += 1
                live.append(made)
                log.append((conv, seq, kind, made, rnd.choice(["user", "assistant", "assistant", None, "a\\b\nc"]), rnd.choice(bits)))
            else:
                message = rnd.choice(live)
                if kind == "regenerate":
                    del live[live.index(message) + 1:]
                log.append((conv, seq, kind, message, None, rnd.choice(bits)))
        log.append((conv, 99, "unknown", 1, None, "no"))
        log.append((conv, 99, "delta", None, None, "no"))
    want = replayed([e for e in log if e[2] != "unknown" and e[3] is not None])
    shuffled = rnd.sample(log, len(log))
    df = spark.createDataFrame([(*e, "x") for e in shuffled], "conv_id long, seq long, kind string, message long, role string, text string, formatted string")
    done = chats.render(chats.fold(df))
    rows = done.select("conv_id", "formatted", "loss_spans", chats.read_turns(F.col("formatted")).alias("turns"),
                       chats.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in rows} == want
    for r in rows:
        assert r.loss == "".join(t for role, t in want[r.conv_id] if role == "assistant")
        assert all(r.formatted[:s.start].endswith("### assistant\n") and r.formatted[s.end:].startswith("\n</turn>\n") for s in r.loss_spans)


def test_awkward_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert queries.chat_rows(spark.createDataFrame([], schema)).collect() == []
    long = "wörd \\### </turn> " * 20_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (1, 1, "assistant", long), (2, None, None, None), (None, 0, "assistant", ""), (3, 0, "assistant", None)]
    got = {r.conv_id: r for r in queries.chat_rows(spark.createDataFrame(rows, schema)).collect()}
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (3, 2 * len(long), sha(long + long))
    assert (got[2].turns_sha256, got[2].loss_sha256, got[None].n_turns, got[3].loss_chars) == (sha("\n\n"), sha(""), 1, 0)


# --- texts in other scripts


def test_chunks_of_many_scripts_equal_the_library(monkeypatch):
    import numpy as np

    from tally.llm import bpe

    monkeypatch.setattr(bpe, "MIN_CHUNK", 3)
    monkeypatch.setattr(bpe, "CHUNK_BITS", 2)
    enc, ids_only, rnd = bpe.Encoder(queries.WORD_BPE), bpe.Encoder(queries.WORD_BPE, decode=False), random.Random(2)
    texts = ["“Привет”, мир — 5 €", "漢字かな、カナ。한국어 문장", "d’été ‘s ’s"]
    for _ in range(2000):
        ranges = rnd.sample(bpe.PLAIN_RANGES, 2)
        texts.append("".join(chr(rnd.randint(*rnd.choice(ranges))) if rnd.random() < 0.6 else rnd.choice("ab'sdtre \n!12é") for _ in range(rnd.randint(0, 30))))
    for t in texts:
        assert bpe.PLAIN.fullmatch(t)
        ids = enc.tok.encode(t, add_special_tokens=False).ids
        data = np.array(ids, "<u4").tobytes()
        assert enc.encode(t) == (data, enc.tok.decode(ids, skip_special_tokens=False)) and ids_only.encode(t) == (data, ""), t
    assert enc.reused and enc.repaired


def test_shards_of_numbers_far_apart(spark):
    """Any longs, null among them; equal texts are neighbours and bytes nearly equal."""
    from tally.llm import shards

    numbers = [-(1 << 63), (1 << 63) - 1, -1, 0, 1, 1 << 62, -(1 << 62), None, *range(5, 400)]
    rows = [(n, "t" * (k % 50) if k % 3 else None) for k, n in enumerate(numbers)]
    got = shards.histogram_shards(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert sorted((str(r.doc_id), r.text) for r in got if r.text) == sorted((str(n), t) for n, t in rows if t)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
        assert r.text_crc32 == zlib.crc32((r.text or "").encode())
    assert max(sizes.values()) - min(sizes.values()) <= 120
    for shard in range(4):
        own = sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        keys = [(r.text_crc32, r.doc_id is not None, r.doc_id or 0) for r in own]
        assert keys == sorted(keys)
