"""The manifest, the mixture and the divergence audit against plain Python versions."""

import re
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from quarrylake.llm import divergence, manifest, mixture

# --- manifest ---


def encoded(*values):
    out = b""
    for value in values:
        raw = None if value is None else str(value).encode()
        out += b"-" if raw is None else str(len(raw)).encode() + b":" + raw
    return sha256(out).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha256("".join(below[i : i + 3]).encode()).hexdigest() for i in range(0, len(below), 3)])
    return levels


def climbed(levels, place, node, proof):
    for nodes in levels[:-1]:
        start = place - place % 3
        run = nodes[start : start + 3]
        proof += run[: place % 3] + run[place % 3 + 1 :]
        run[place % 3] = node
        node, place = sha256("".join(run).encode()).hexdigest(), place // 3
    return node


def brute_manifest(rows, strip):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of (doc_id, source, lang, n_chars, text)."""
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        held = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, encoded(*r)))
        trees[source] = held, tree([encoded(*r) for r in held])
    top = tree([trees[s][1][-1][0] for s in order])
    out = []
    for place, source in enumerate(order):
        held, levels = trees[source]
        for i, row in enumerate(held):
            seen = encoded(*row[:4], None if row[4] is None else row[4].replace("\n", "") if strip(row[0]) else row[4])
            proof = []
            folded = climbed(top, place, climbed(levels, i, seen, proof), proof)
            out.append((row[0], levels[0][i], levels[-1][0], top[-1][0], "".join(proof), folded, folded == top[-1][0]))
    return out


def even(doc_id):
    return doc_id is not None and crc32(str(doc_id).encode()) % 2 == 0


def proved(docs, **options):
    stripped = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    return manifest.manifest(docs, seen={"text": F.coalesce(stripped, "text")}, **options)


def as_rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]


KEPT = ("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified")


def same(found, wanted):
    return sorted(map(str, found)) == sorted(map(str, wanted))


def test_manifest_of_odd_rows(documents, odd):
    docs = documents(*odd).unionByName(documents((70, "a\nb"), (71, "a\nb\n"), (72, "\n"), source=None))
    docs = docs.unionByName(documents((5, "x"), source="")).unionByName(documents((6, "é\n"), (-3, "y"), source="Éa\n"))
    found = [tuple(r) for r in proved(docs).select(*KEPT).collect()]
    assert same(found, brute_manifest(as_rows(docs), even))
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("heights", [1, 2])
def test_manifest_of_many_layers(documents, heights):
    docs = documents(*[(i, f"text\n{i}") for i in range(100)], source="big")
    for n in range(14):
        docs = docs.unionByName(documents(*[(1000 + 10 * n + i, "t\n") for i in range(n % 5 + 1)], source=f"s{n}"))
    found = [tuple(r) for r in proved(docs, heights=heights).select(*KEPT).collect()]
    assert same(found, brute_manifest(as_rows(docs), even))


def test_proof_and_path_are_enough_to_fold(documents):
    docs = documents(*[(i, f"text {i}") for i in range(30)]).unionByName(documents((40, "z"), source="q"))
    for r in manifest.manifest(docs).collect():
        steps, used = [], 0
        for at in range(0, len(r.path), 2):
            place, others = int(r.path[at]), int(r.path[at + 1]) - 1
            steps.append((place, r.proof[used : used + 64 * others]))
            used += 64 * others
        assert used == len(r.proof) and manifest.fold(r.leaf, steps) == r.root and r.verified


def test_manifest_of_one_row_and_of_none(documents):
    [only] = manifest.manifest(documents((1, "a"))).collect()
    assert only.leaf == only.subroot == only.root == only.folded_root and only.proof == "" and only.verified
    assert manifest.manifest(documents((1, "a")).where("false")).count() == 0


# --- mixture ---


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(size_of):
    order = sorted(size_of, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, fixed, rest = dict.fromkeys(order, 0.0), set(), 1.5 * sum(size_of.values())
    while True:
        left = rest - sum(target[s] for s in fixed)
        level = sum(weight[s] for s in order if s not in fixed)
        for s in order:
            if s not in fixed:
                target[s] = weight[s] * left / level
        above = [s for s in order if s not in fixed and target[s] >= 2 * size_of[s]]
        if not above:
            return target
        fixed |= set(above)
        target |= {s: 2.0 * size_of[s] for s in above}
        if len(fixed) == len(order):
            return target


def check_mix(rows, found, id_name="doc_id"):
    size_of = Counter()
    for r in rows:
        size_of[r["source"]] += words(r["text"])
    targets = brute_targets(size_of)
    assert sorted((str(r[id_name]), words(r["text"])) for r in rows) == sorted((str(r[id_name]), r["size"]) for r in found)
    taken, largest = Counter(), Counter()
    for r in found:
        rate = targets[r["source"]] / size_of[r["source"]] if size_of[r["source"]] else 0
        assert r["source_size"] == size_of[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and (not r["size"] or int(rate) <= r["copies"] <= min(2, int(rate) + 1))
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source in size_of:
        assert abs(taken[source] - targets[source]) <= largest[source]


def test_mixture_of_odd_rows(documents, odd, text):
    docs = documents(*odd).unionByName(documents(*[(100 + i, text(i, 5 + i)) for i in range(60)], source=None))
    docs = docs.unionByName(documents((1, None), (2, ""), (2, " "), source="")).unionByName(documents((7, "a b"), source="\U0001f600"))
    mixed = mixture.mix(docs)
    found = [r.asDict() for r in mixed.collect()]
    check_mix([r.asDict() for r in docs.collect()], found)
    again = [r.asDict() for r in mixture.mix(docs.repartition(5)).collect()]
    assert sorted(map(str, found)) == sorted(map(str, again))


@pytest.mark.parametrize("block", [2, 5])
def test_mixture_by_a_deep_tree(documents, text, monkeypatch, block):
    monkeypatch.setattr(mixture, "BLOCK", block)
    docs = documents(*[(i, text(i, 1 + i * i % 37)) for i in range(200)], source="big")
    docs = docs.unionByName(documents((500, text(1, 30)), source="a")).unionByName(documents(*[(600 + i, text(i, 9)) for i in range(31)]))
    check_mix([r.asDict() for r in docs.collect()], [r.asDict() for r in mixture.mix(docs).collect()])


def test_copies_have_their_probabilities(spark):
    """300 mixes of the same 40 documents, each under a key of its own."""
    chance = [0.1, 0.35, 0.5, 0.9]
    units = spark.range(300 * 40).select(
        F.concat(F.lit("+"), F.floor(F.col("id") / 40)).alias("key"),
        (F.col("id") % 40).alias("rank"),
        F.lit(40).cast("long").alias("members"),
        (F.col("id") % 40).alias("id"),
        (F.col("id") % 40 % 7 + 1).alias("size"),
    )
    mass = F.col("size") * F.element_at(F.array(*map(F.lit, chance)), (F.col("rank") % 4 + 1).cast("int"))
    taken = mixture.rounded(units.withColumn("mass", mass), 1).groupBy("id").agg(F.avg("whole").alias("mean")).collect()
    assert len(taken) == 40
    assert all(abs(r["mean"] - chance[r["id"] % 4]) < 0.12 for r in taken)
    assert abs(sum(r["mean"] - chance[r["id"] % 4] for r in taken)) < 0.5


def test_empty_mixtures(documents):
    assert mixture.mix(documents((1, "a")).where("false")).count() == 0
    [row] = mixture.mix(documents((1, None))).collect()
    assert (row["size"], row["target"], row["taken"]) == (0, 0.0, 0)


# --- divergence ---


def brute_audit(rows, least_docs=10, top=10):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in ((r["lang"] or "", r["source"] or "", r["text"] or "") for r in rows):
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        held = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        held[None] = {t: sum(held[s][t] for s in sources) for t in kept}
        share = {
            s: {t: 1 + 10**9 * (n + 2) // (sum(c.values()) + 2 * len(kept)) for t, n in c.items()} for s, c in held.items()
        }
        apart = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            pairs = [(o, sum(apart(share[s][t], share[o][t]) for t in kept)) for o in sources - {s}]
            terms = [(t, apart(share[s][t], share[None][t])) for t in kept if held[s][t] and share[s][t] > share[None][t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(items, key=lambda i: (-i[1], i[0].encode()))[:most]
                out += [(lang, s, part, item, value, rank + 1) for rank, (item, value) in enumerate(ordered)]
    return sorted(out)


def test_divergence_of_odd_rows(documents, odd, text):
    docs = documents(*odd, lang="en")
    for source in ("a", "B", None, "é"):
        for lang in ("en", "de"):
            shift = len(source or "") + (lang == "de")
            docs = docs.unionByName(documents(*[(i, text(i % 7 + shift, 30).upper()) for i in range(12)], lang=lang, source=source))
    docs = docs.unionByName(documents((1, "one two"), (2, None), source="x")).unionByName(documents((3, "..."), source="y"))
    docs = docs.unionByName(documents((4, "lonely"), lang="fr", source="only"))
    found = sorted(tuple(r) for r in divergence.audit(docs, held=50, terms_per_block=16, cells=40).collect())
    assert found == brute_audit([r.asDict() for r in docs.collect()])
    assert ("", "x", "pair", "y", 0, 1) in found and not [r for r in found if r[0] == "fr"]


def test_shares_do_not_overflow():
    import numpy as np

    counts, total = np.array([0, 7, 10**14, 9 * 10**14]), np.array([9 * 10**14 + 2000])
    assert divergence._share(counts, total).tolist() == [1 + 10**9 * (int(c) + 2) // int(total[0]) for c in counts]


def test_divergence_of_an_empty_table(documents):
    assert divergence.audit(documents((1, "a")).where("false")).count() == 0
