"""Decontamination, training from the tables and the whole pipeline against plain Python."""

import hashlib
import json
import math
import random
import zlib
from collections import Counter

import corpus_pipeline
import pytest
import regex
from pyspark.sql import functions as F
from test_operators import prose

from fieldloom.llm import decontaminate, quality, toxicity
from fieldloom.llm.queries import fold, table

SF = "/root/testdata/sf0.01"

# 5 ------------------------------------------------------------------------------

UNITS = decontaminate.UNITS
SLOT = "\x01"


def parts(text, template):
    """Tokens and slot values of a text, token by token."""
    x = regex.sub(r"\n[^\S\n]*\n", "\n.\n", text)
    x = regex.sub(r"[\s\p{Z}]+", " ", x)
    found = []
    pattern = r"(?<name>(?<![\p{L}\p{M}\p{Nd}])\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*)|" if template else ""
    at, tokens = 0, []
    words = lambda s: [t for t in regex.split(r"[^\p{L}\p{M}]+", s.lower()) if t]
    for m in regex.finditer(pattern + rf"(?<number>[0-9]+(?:[.,][0-9]+)*)(?<unit> ?(?i:{UNITS})\b)?", x):
        tokens += words(x[at : m.start()])
        if template and m["name"]:
            tokens.append(SLOT + "n")
            found.append(m["name"].lower())
        else:
            tokens.append(SLOT + "d")
            found.append(m["number"])
            if m["unit"]:
                tokens.append(SLOT + "u")
                found.append(m["unit"].strip().lower())
        at = m.end()
    tokens += words(x[at:])
    values = iter(found)
    return tokens, [next(values) if t[0] == SLOT else None for t in tokens]


def brute_leaks(docs, items, width=8, coverage=0.5, passage=50):
    out = set()
    for doc_id, text in docs:
        for item_id, item in items:
            best, longest = None, 0
            for template in (False, True):
                tokens, values = parts(item, template)
                if not tokens or template and not (SLOT + "n" in tokens and sum(t[0] != SLOT for t in tokens) >= 3):
                    continue
                own, fills = parts(text or "", template)
                w = min(width, len(tokens))
                n = len(tokens) - w + 1
                spots = {}
                for p in range(n):
                    spots.setdefault(tuple(tokens[p : p + w]), []).append(p)
                lines = {}
                for p in range(len(own) - w + 1):
                    for q in spots.get(tuple(own[p : p + w]), ()):
                        lines.setdefault(p - q, set()).add(q)
                matched, same = set(), True
                for shift, places in lines.items():
                    covered = sorted({p for q in places for p in range(q, q + w) if tokens[p][0] == SLOT})
                    pairs = {p: (values[p], fills[p + shift]) for p in covered}
                    bad = {p for p, (a, b) in pairs.items() if a != b and any((a == c) != (b == d) for c, d in pairs.values())}
                    places = {q for q in places if not bad & set(range(q, q + w))}
                    if places:
                        matched |= places
                        same &= all(a == b for a, b in pairs.values())
                        ends = [q for q in places if q + 1 not in places]
                        longest = max(longest, w - 1 + max(next(k for k in range(1, n + 2) if e - k not in places) for e in ends))
                if matched and (best is None or len(matched) / n > best[0]):
                    best = (len(matched) / n, len(matched), n, "verbatim" if same else "re-parameterised")
            if best and (best[0] >= coverage or longest >= passage):
                out.add((doc_id, item_id, *best[1:]))
    return out


def leak_tables():
    rng = random.Random(9)
    items = [
        (1, "Tom has 5 apples. Tom gives 2 apples to Ann and walks 3 km home. How many apples does Tom have left?"),
        (2, "A train leaves the old station at 9.30 and runs 120 km in 2 hours. What is its mean speed?"),
        (3, "Name 4 rivers"),
        (4, prose(40, rng)),
        (5, prose(200, rng)),
        (6, "Sell 3 apples and 3 pears to the 3 neighbours of the 3 farms in 3 villages by the sea"),
    ]
    docs = [(10, f"{prose(20, rng)}\n{items[0][1]}\n{prose(20, rng)}"), (11, items[0][1].replace("Tom", "Bob").replace("5", "17").replace("3 km", "8 miles"))]
    docs += [(12, items[0][1].replace("Tom has", "Eve has").replace("5", "17")), (13, items[1][1].upper()), (14, "Name 4 rivers and more"), (15, None), (16, "")]
    docs += [(17, f"{prose(900, rng)} {items[3][1]} {prose(9000, rng)}"), (18, items[3][1][: len(items[3][1]) * 2 // 3]), (19, prose(60, rng)), (20, items[1][1].replace("120", "360").replace("2 hours", "6 hours")), (10, f"{items[1][1]}")]
    quoted = items[4][1].split()
    docs += [(21, f"{prose(30, rng)} {' '.join(quoted[70:122])} {prose(30, rng)}"), (22, " ".join(quoted[20:65])), (23, items[3][1] + " 5 " + items[0][1].replace("2 apples", "5 apples"))]
    docs += [(24, "Sell 4 apples and 5 pears to the 6 neighbours of the 7 farms in 8 villages by the sea"), (25, items[5][1].replace("3", "9"))]
    return docs, items


def test_leaks_against_brute_force(spark):
    docs, items = leak_tables()
    tables = [(docs, items)]
    read = lambda name, key: [(r[key], r["text"]) for r in table(spark, "/root/testdata/sf0.001", name).collect()]
    tables.append((read("documents", "doc_id"), read("benchmark", "item_id")))
    for own, bench in tables:
        d, b = spark.createDataFrame(own, "doc_id long, text string"), spark.createDataFrame([*bench, (99, None), (98, "")], "item_id long, text string")
        got = {(r.doc_id, r.item_id, r.matched, r.windows, r.kind) for r in decontaminate.find_leaks(d, b).collect()}
        want = brute_leaks(own, bench)
        assert got == want and want
        if bench is items:
            assert {(21, 5), (23, 1), (23, 4), (25, 6)} <= {x[:2] for x in got} and not {22, 24} & {x[0] for x in got}
    assert decontaminate.find_leaks(d.where("false"), b).count() == 0 == decontaminate.find_leaks(d, b.where("false")).count()


# 3 and 6 --------------------------------------------------------------------------


def test_toxicity_from_the_tables(spark):
    """Held-out rows of the 1,000-document table: 33 toxic documents to learn from."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    net = toxicity.train_toxicity(docs, labels, keep=fold(3) != 1)
    held = toxicity.score_toxicity(docs, net).join(labels, "doc_id").where(fold(3) == 1)
    toxic, found, wrong = held.agg(F.expr("count_if(toxic = 1)"), F.expr("count_if(toxic = 1 and score >= 0.7)"), F.expr("count_if(toxic = 0 and score >= 0.7)")).first()
    assert toxic == 18 and found >= 11 and wrong <= 3
    odd = labels.select("doc_id", "toxic").limit(5).unionByName(spark.createDataFrame([(None, 1), (1, None), (1, 0), (1, 1), (10**9, 1)], "doc_id long, toxic int"))
    texts = docs.unionByName(docs.limit(3)).withColumn("text", F.when(F.col("doc_id") % 7 == 0, None).otherwise(F.col("text")))
    scores = toxicity.score_toxicity(texts, toxicity.train_toxicity(texts, odd))
    assert scores.count() == 1003 and scores.where("score is null or score < 0 or score > 1").count() == 0


def test_quality_from_the_tables(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.train_quality(docs, labels, keep=fold(5) != 0)
    held = quality.score_quality(docs, model).join(labels, "doc_id").where(fold(5) == 0)
    good, kept, poor, wrong = held.agg(F.expr("count_if(quality = 1)"), F.expr("count_if(quality = 1 and score >= 0.3)"), F.expr("count_if(quality = 0)"), F.expr("count_if(quality = 0 and score >= 0.3)")).first()
    assert kept >= 0.95 * good and wrong <= 0.3 * poor
    nothing = quality.train_quality(docs.where("false"), labels.where("false"))
    assert quality.score_quality(docs.limit(4), nothing).count() == 4


# pipeline -------------------------------------------------------------------------


def row_key(doc_id, text):
    return hashlib.md5("\x1f".join("~" if x is None else f"={x}" for x in (doc_id, text)).encode()).digest()


def near_copies(docs):
    """Each group's row with the least key, and every row without words."""
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    words = [[w for w in regex.split(r"[\x20\x09-\x0D]+", lower(t)) if w] for _, t, _ in docs]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set() for w in words]
    root = list(range(len(docs)))
    for i, s in enumerate(sets):
        for j in range(i):
            if s and 100 * len(s & sets[j]) >= 80 * len(s | sets[j]) and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    groups = {}
    for i, row in enumerate(docs):
        if sets[i]:
            groups.setdefault(root[i], []).append(row)
    return [row for i, row in enumerate(docs) if not sets[i]] + [min(g, key=lambda r: row_key(r[0], r[1])) for g in groups.values()]


def mixed(docs):
    size = Counter()
    for _, t, s in docs:
        size[s] += len((t or "").encode())
    raw = {s: math.pow(n, 0.5) for s, n in size.items()}
    out = []
    for doc_id, t, s in docs:
        rate = raw[s] / sum(raw.values()) * sum(size.values()) / size[s] if size[s] else 1.0
        digest = hashlib.md5(("~" if t is None else t).encode()).hexdigest()
        u = (int(hashlib.md5(f"17:{'~' if doc_id is None else doc_id}:{digest}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        n, p = 0, math.exp(-rate)
        total = p
        while total < u and n < 1000:
            n += 1
            p *= rate / n
            total += p
        out += [(doc_id, t)] * n
    return out


def sharded(docs, shards=16):
    """(id, size, crc, shard, slot) by the order of text hash, id and checksum."""
    raw = [(doc_id, (t or "").encode()) for doc_id, t in docs]
    rows = sorted((int(hashlib.md5(b).hexdigest()[:15], 16), doc_id is not None, doc_id or 0, zlib.crc32(b), len(b) + 1) for doc_id, b in raw)
    total, before, slots, out = sum(r[4] for r in rows), 0, Counter(), []
    for _, has, doc_id, crc, size in rows:
        shard = min(int((before + size / 2) * shards / total), shards - 1)
        out.append((doc_id if has else None, size, crc, shard, slots[shard]))
        slots[shard] += 1
        before += size
    return sorted(map(repr, out))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """documents with nulls, empty and long texts, repeated rows, near copies, leaks and clashing columns; labels; benchmark."""
    rng = random.Random(21)
    leaks, items = leak_tables()
    bad, rows = ["grolb", "snarv", "vitz", "plook", "drunt"], []
    for k in range(240):
        words = prose(rng.randint(30, 90), rng).split()
        if k < 80:  # toxic
            for place in sorted(rng.sample(range(len(words)), 4)):
                words[place] = rng.choice(bad)
        rows.append((1000 + k, " ".join(words), f"s{k % 3}"))
    base = prose(80, rng)
    rows += [(2000 + k, base + f" tail{k}", "s0" if k % 2 else None) for k in range(6)] + [(2100, base, "tiny"), (2100, base, "tiny"), (None, prose(30, rng), "s1"), (2200, prose(6000, rng), "s2")]
    rows += [(3000, None, "s1"), (3001, "", "s1"), (3002, " \n", None)] + [(doc_id, t, "s2") for doc_id, t in leaks]
    path = tmp_path_factory.mktemp("corpus")
    extra = {n: F.lit(f"own {n}") for n in ("__rid", "__key", "__size", "score", "shard", "replica")}
    docs = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumns(extra)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1000 + k, 1, int(k < 80)) for k in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([*items, (99, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), items


def triples(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]


def test_pipeline_against_brute_force(spark, folder):
    path, items = folder
    docs = table(spark, path, "documents")
    after = corpus_pipeline.drop_toxic(spark, docs, path)
    assert after.columns == docs.columns
    kept, rows = triples(after), triples(docs)
    held = [i for i in range(1000, 1240) if zlib.crc32(str(i).encode()) % 3 == 1]
    ids = {i for i, _, _ in kept}
    toxic = [i for i in held if i < 1080]
    assert sum(i in ids for i in toxic) <= 0.1 * len(toxic) and sum(i not in ids for i in held if i >= 1080) <= 2
    assert Counter(r for r in rows if not (r[1] or "").strip()) == Counter(r for r in kept if not (r[1] or "").strip())
    one = near_copies(kept)
    leaking = {(i, t) for i, t, _ in one if brute_leaks([(i, t)], items)}
    left = [r for r in one if (r[0], r[1]) not in leaking]
    assert leaking and len(left) < len(one) < len(kept)
    got = [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in corpus_pipeline.run(spark, path).collect()]
    assert sorted(map(repr, got)) == sharded(mixed(left))


def test_pipeline_on_nothing(spark, folder, tmp_path):
    path, _ = folder
    for name in ("documents", "labels", "benchmark"):
        table(spark, path, name).where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert json.dumps([n for n, _ in corpus_pipeline.STAGES]) == '["toxicity", "near_copies", "decontamination", "mixing", "sharding"]'
