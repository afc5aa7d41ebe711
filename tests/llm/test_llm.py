"""Texts and duplicate groups: exact round trips, brute force, held-out labels, hot groups, dirt."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import SMALL, rows
from tests.oracle import connect, plain

from pyspark.sql import functions as F
from snapledger.functions import is_missing
from snapledger.llm import consensus, mixing, queries, subjects, tokens

C = F.col


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    got = queries.QUERIES[name](spark, SMALL)
    frame = got.toPandas()
    spark.catalog.clearCache()
    if name in queries.ORACLES:
        want = connect(SMALL).execute(queries.ORACLES[name]).df()
        assert sorted(frame.columns) == sorted(want.columns) and plain(frame) == plain(want)


def test_nothing_else_needs_the_subpackage():
    from pathlib import Path

    root = Path(__file__).resolve().parents[2] / "snapledger"
    for p in root.rglob("*.py"):
        if "llm" not in p.parts:
            assert "llm" not in p.read_text().replace("``llm``", ""), p


# --------------------------------------------------------------------------- tokens


@pytest.fixture(scope="module")
def public():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{tokens.TOKENIZER_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_encoding_equals_the_public_tokenizer(spark, public):
    rnd = random.Random(11)
    pool = [chr(c) for c in [*range(1, 0x600), *range(0x1C80, 0x3100), *range(0x1F300, 0x1F680), *range(0x10300, 0x11400), *range(0x1E000, 0x1E950)]]
    texts = ["".join(rnd.choice(pool) if rnd.random() < 0.5 else rnd.choice(" ab1's\n\t") for _ in range(rnd.randint(0, 50))) for _ in range(800)]
    texts += ["", None, " ", "\n\n  x", "it's we'll I'D", "<|endoftext|>", "a" * 30_000, "x y " * 8_000, " " * 3000, "𝔘𝔫𝔦", "é", "﻿x"]
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], "n bigint, t string, word string, ids string").repartition(4)
    got = {r["n"]: r["ids"] for r in tokens.encode_corpus(df, "n", "t").collect()}
    want = public(texts)
    assert [i for i, w in enumerate(want) if got[i] != w] == []


def test_encoding_keeps_rows_and_decodes(spark):
    data = [(1, "twice"), (1, "twice"), (1, "other"), (None, "no key"), (None, "no key"), (2, None), (3, "")]
    df = spark.createDataFrame(data, "k bigint, t string")
    got = tokens.encode_corpus(df, "k", "t")
    assert got.count() == len(data)
    assert [r["ids"] for r in got.filter("k IN (2, 3)").collect()] == [[], []]
    assert got.filter("k IS NULL").count() == 2
    assert tokens.encode_corpus(df.limit(0), "k", "t").count() == 0
    sized = tokens.with_token_counts(df.withColumn("ids", F.lit("clash")), "t", heavy_share=0.2)
    assert rows(sized, "k", "n_tokens") == sorted(((r["k"], len(r["ids"])) for r in got.collect()), key=lambda t: (t[0] is not None, str(t[0]), t[1]))
    assert tokens.with_token_counts(df.limit(0), "t").count() == 0
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(["", "næste\n\n  dag – 3,5 €", "日本語 🙂" * 50])], "k bigint, t string")
    back = tokens.decode_corpus(tokens.encode_corpus(texts, "k", "t"), "k")
    assert rows(back) == rows(texts)


def test_heavy_and_rare_words_take_both_ways(spark, public):
    texts = ["the cat " * 50 + f"word{i}" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "k bigint, t string")
    want = public(texts)
    for share in (1e-9, 0.01, 1.0):
        got = {r["k"]: r["ids"] for r in tokens.encode_corpus(df, "k", "t", heavy_share=share).collect()}
        assert all(got[i] == w for i, w in enumerate(want))


# --------------------------------------------------------------------------- consensus


def survive(spark, data, columns=("v",), rank=False, weight=None, **kw):
    schema = "g string, r int, " + ", ".join(f"{c} string" for c in columns)
    df = spark.createDataFrame(data, schema)
    out = consensus.survivors(df, C("g"), {c: C(c) for c in columns}, rank=C("r") if rank else None, weight=C(weight) if weight else None, **kw)
    return rows(out, "group_key", "column_name", "value")


def brute_align(a, b):
    """All cells of the table; from the end a replacement, then a gap in b, then one in a."""
    best = [[i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            best[i][j] = min(best[i - 1][j - 1] + (a[i - 1] != b[j - 1]), best[i - 1][j] + 1, best[i][j - 1] + 1)
    return best


def brute_survivor(data):
    """data: (value, weight, rank) of one group, one row each: votes summed in plain dictionaries."""
    held = {}
    for v, w, r in data:
        old = held.get(v, (0, -1))
        held[v] = (old[0] + w, max(old[1], r))
    centre = max(held, key=lambda v: (*held[v], v))
    total = sum(w for w, _ in held.values())
    cells = {}
    for v, (w, r) in held.items():
        for pos, ins, token in consensus.align(consensus.tokens(centre), consensus.tokens(v)):
            cell = cells.setdefault((pos, ins), {})
            cell[token] = (cell.get(token, (0, -1))[0] + w, max(cell.get(token, (0, -1))[1], r))
    won = []
    for (pos, ins), cell in cells.items():
        token = max(cell, key=lambda t: (*cell[t], t))
        if cell[token][0] > total - sum(w for w, _ in cell.values()):
            won.append((pos, ins, token))
    wanted = consensus.apply_edits(consensus.tokens(centre), won)
    return min(held, key=lambda v: (brute_align(consensus.tokens(v), wanted)[-1][-1], -held[v][0], -held[v][1], [-ord(ch) for ch in v] + [1]))


def test_survivors_against_brute_force(spark):
    rnd = random.Random(8)
    groups, data = {}, []
    for g in range(120):
        words = [rnd.choice("abcde") for _ in range(rnd.randint(1, 6))]
        for _ in range(rnd.randint(1, 9)):
            copy = [w if rnd.random() > 0.25 else rnd.choice("abcdx") for w in words if rnd.random() > 0.1] or ["z"]
            row = (" ".join(copy), rnd.randint(1, 5), rnd.randint(0, 99))
            groups.setdefault(str(g), []).append(row)
            data.append((str(g), row[2], row[0], row[1]))
    df = spark.createDataFrame(data, "g string, r int, v string, w int")
    got = {r["group_key"]: r["value"] for r in consensus.survivors(df, C("g"), {"v": C("v")}, weight=C("w"), rank=C("r"), hot_share=0.02).collect()}
    want = {g: brute_survivor(d) for g, d in groups.items()}
    assert got == want
    # the vote decides: in many groups the survivor is not the value of the best row
    best = {g: max(d, key=lambda t: (t[2], t[1], t[0]))[0] for g, d in groups.items()}
    assert sum(got[g] != best[g] for g in groups) > 10
    again = consensus.survivors(df.repartition(7), C("g"), {"v": C("v")}, weight=C("w"), rank=C("r"), hot_share=1.0)
    assert {r["group_key"]: r["value"] for r in again.collect()} == want


def test_tokens_vote_and_an_existing_value_survives(spark):
    data = [("g", 0, "Acme Medical Devices Ltd"), ("g", 0, "Acme Medical Device Ltd"), ("g", 0, "Acme Medcal Devices Ltd"), ("g", 0, "ACME Medical Devices Ltd")]
    assert survive(spark, data) == [("g", "v", "Acme Medical Devices Ltd")]
    # no single row has the consensus "a b c d": the closest does, the heavier of two
    assert survive(spark, [("g", 0, "a b c x"), ("g", 0, "a b y d"), ("g", 0, "a b y d"), ("g", 0, "z b c d")])[0][2] == "a b y d"


def test_votes_overrule_the_best_row(spark):
    # the best row stands alone against three that agree but for one word each
    data = [("g", 9, "q w e r"), ("g", 1, "a b c x"), ("g", 1, "a b y d"), ("g", 1, "z b c d")]
    assert survive(spark, data, rank=True, pool="max")[0][2] != "q w e r"
    # unless it weighs more than they do together
    assert survive(spark, [*data, *[("g", 9, "q w e r")] * 3], rank=True)[0][2] == "q w e r"


def test_every_column_gets_a_survivor(spark):
    from tests.conftest import SMALL

    got = {r[0] for r in queries.p5_consensus(spark, SMALL).select("column_name").distinct().collect()}
    inventory = spark.read.parquet(f"{SMALL}/candidate_inventory.parquet")
    filled = {c for c in inventory.columns if inventory.filter(~is_missing(c)).count()}
    assert got == filled - {"primary_di_code"} and {"latest_version", "version_number", "ulid"} <= got


def test_rank_breaks_ties_field_by_field(spark):
    data = [("g", 3, None, "b3"), ("g", 2, "a2", "b1"), *[("g", 1, "a1", "b1")] * 9, ("g", 0, "a0", None), (None, 9, "x", "x")]
    assert survive(spark, data, ("p", "q"), rank=True, pool="max") == [("g", "p", "a2"), ("g", "q", "b3")]
    assert survive(spark, data, ("p", "q"), rank=True) == [("g", "p", "a1"), ("g", "q", "b1")]


def test_consensus_edges(spark):
    assert survive(spark, []) == []
    assert survive(spark, [("g", 0, None)]) == []
    assert survive(spark, [("g", 0, "only"), ("g", 0, "only")]) == [("g", "v", "only")]
    assert survive(spark, [("g", 0, "b"), ("g", 0, "a")]) == [("g", "v", "b")]
    assert survive(spark, [("g", 0, ""), ("g", 0, ""), ("g", 0, "a")]) == [("g", "v", "")]
    long = "word " * 4000
    assert survive(spark, [("g", 0, long + "end"), ("g", 0, long + "end"), ("g", 0, long + "other")])[0][2] == long + "end"
    with pytest.raises(ValueError):
        survive(spark, [("g", 0, "a")], pool="some")


def test_hot_group_of_distinct_values(spark):
    """A third of all rows in one group, each with a value of its own, under a heap of 3 GB."""
    n = 100_000
    hot = spark.range(n).select(F.lit("hot").alias("g"), C("id").cast("int").alias("r"), F.concat(F.lit("dev "), F.md5(C("id").cast("string")), F.lit(" model A")).alias("v"))
    cold = spark.range(2 * n).select(C("id").cast("string").alias("g"), F.lit(0).alias("r"), F.lit("x").alias("v"))
    out = consensus.survivors(hot.unionByName(cold), C("g"), {"v": C("v")}, rank=C("r")).filter("group_key = 'hot'").collect()
    assert [(r["value"], r["n_values"]) for r in out] == [("dev " + __import__("hashlib").md5(str(n - 1).encode()).hexdigest() + " model A", n)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=9), st.lists(st.sampled_from("abc"), max_size=9))
def test_edits_are_cheapest_and_give_the_value(a, b):
    edits = consensus.align(a, b)
    assert len(edits) == brute_align(a, b)[-1][-1] == consensus.token_distance(a, b)
    assert consensus.apply_edits(a, edits) == b


def test_long_values_align_like_short_ones():
    a = [str(i) for i in range(3000)]
    b = ["x", *a[:1400], *a[1420:2000], "new", *a[2000:], "y"]
    edits = consensus.align(a, b)
    assert len(edits) == 23 and consensus.apply_edits(a, edits) == b
    rnd = random.Random(5)
    for _ in range(40):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randint(0, 60))] for _ in range(2))
        edits = consensus.align(a, b)
        assert consensus.apply_edits(a, edits) == b and len(edits) == brute_align(a, b)[-1][-1]


# --------------------------------------------------------------------------- mixing


def brute_fill(budget, weights, room):
    """A drop at a time: what a full child cannot take is split among the others again."""
    got = [0.0] * len(weights)
    for by in (list(weights), [r if w == 0 else 0.0 for w, r in zip(weights, room, strict=True)]):
        free = [i for i in range(len(by)) if by[i] > 0 and room[i] > got[i]]
        while free and budget - sum(got) > 1e-9:
            unit = (budget - sum(got)) / sum(by[i] for i in free)
            full = [i for i in free if got[i] + unit * by[i] >= room[i]]
            for i in full or free:
                got[i] = room[i] if full else got[i] + unit * by[i]
            free = [i for i in free if i not in full] if full else []
    return got


def test_water_fill(spark):
    rnd = random.Random(3)
    cases = [(100, [1, 1], [100, 100]), (100, [1, 1], [10, 100]), (100, [3, 1, 1], [10, 20, 30]), (100, [1, 0], [40, 100]), (0, [1, 2], [5, 5]), (10, [0, 0], [30, 10]), (10, [1], [0])]
    for _ in range(60):
        n = rnd.randint(1, 6)
        cases.append((rnd.randint(0, 100), [rnd.choice([0, 1, 2, 5]) for _ in range(n)], [rnd.choice([0, 5, 20, 20, 60]) for _ in range(n)]))
    data = [(p, f"c{i}", float(b), float(w), float(r)) for p, (b, ws, rs) in enumerate(cases) for i, (w, r) in enumerate(zip(ws, rs, strict=True))]
    df = spark.createDataFrame(data, "p int, c string, budget double, weight double, room double")
    got = {(r["p"], r["c"]): r["got"] for r in mixing.water_fill(df, ["p"], "c").collect()}
    for p, (b, ws, rs) in enumerate(cases):
        assert [got[p, f"c{i}"] for i in range(len(ws))] == pytest.approx(brute_fill(b, ws, rs), abs=1e-6), cases[p]


def split(spark, leaves, total):
    df = spark.createDataFrame(leaves, "d string, l string, s string, weight double, room double")
    return {(r["d"], r["l"], r["s"]): round(r["budget"], 6) for r in mixing.budgets(df, ["d", "l", "s"], F.lit(total)).collect()}


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = [("d1", "en", "s1", 0.25, 100.0), ("d1", "en", "s2", 0.25, 1000.0), ("d2", "en", "s3", 0.5, 1000.0)]
    assert split(spark, leaves, 1000) == {("d1", "en", "s1"): 100, ("d1", "en", "s2"): 400, ("d2", "en", "s3"): 500}
    # the language's siblings are full too: then the other language of the domain, then the other domain
    leaves = [("d1", "en", "s1", 0.4, 100.0), ("d1", "da", "s1", 0.1, 250.0), ("d2", "en", "s3", 0.5, 1000.0)]
    assert split(spark, leaves, 1000) == {("d1", "en", "s1"): 100, ("d1", "da", "s1"): 250, ("d2", "en", "s3"): 650}
    assert split(spark, [], 10) == {}


def test_a_source_keeps_its_share_in_every_language(spark):
    """Targets go down the tree by what each leaf holds, so a source that has enough is never short in a language."""
    docs = [(i, "big" if i % 3 else "other", ["en", "da", "de"][min(2, i % 7)], "d" if i % 3 else "e", 10) for i in range(2100)]
    df = spark.createDataFrame(docs, "k bigint, s string, l string, d string, n int")
    targets = spark.createDataFrame([("big", 0.6, 1), ("other", 0.4, 2)], "s string, target_share double, max_repeats bigint")
    got = {r["s"]: r for r in mixing.shares(mixing.choose(df, "k", "n", ["d", "l", "s"], targets, "s"), targets, "s").collect()}
    assert abs(got["big"]["actual_share"] - 0.6) < 0.005 and abs(got["other"]["actual_share"] - 0.4) < 0.005


def brute_prefix(docs, seed_order, rest):
    taken, total = set(), 0
    for k, t in sorted(docs, key=lambda d: seed_order[d[0]]):
        if total + t > rest:
            break
        total += t
        taken.add(k)
    return taken


@pytest.mark.parametrize("budget", [0, 37, 500, 1234, 5000, 99_999])
def test_prefix_of_epochs_against_brute_force(spark, budget):
    rnd = random.Random(4)
    data = [(i, "s", "en", rnd.randint(0, 9)) for i in range(400)]
    df = spark.createDataFrame([*data, (7, "s", "en", data[7][3]), (None, "s", "en", 5), (900, None, "en", 5), (901, "unlisted", "en", 5)], "k bigint, s string, l string, n int")
    targets = spark.createDataFrame([("s", 1.0, 3)], "s string, target_share double, max_repeats bigint")
    got = {r["k"]: r["repeats"] for r in mixing.choose(df, "k", "n", ["s", "l"], targets, "s", total=budget, seed=9).collect()}
    whole = sum(n for *_, n in data)
    size = min(budget, 3 * whole)
    epochs, rest = divmod(size, whole)
    order = {r["k"]: (r["p"], r["o"], r["k"]) for r in df.filter("k IS NOT NULL").select("k", F.xxhash64(F.lit(9), "k").alias("o"), F.pmod(F.xxhash64(F.lit(9), "k"), F.lit(mixing.SLICES)).alias("p")).distinct().collect()}
    extra = brute_prefix([(k, n) for k, _, _, n in data], order, rest) if rest and epochs < 3 else set()
    assert got == {k: epochs + (k in extra) for k, *_ in data if epochs + (k in extra)}


def test_mix_keeps_shares_and_caps(spark):
    docs = [(i, "big" if i % 10 else "small", "en" if i % 3 else "da", 10 + i % 7) for i in range(3000)]
    df = spark.createDataFrame(docs, "k bigint, s string, l string, n int")
    targets = spark.createDataFrame([("big", 0.8, 1), ("small", 0.2, 4), ("none", 0.0, 1)], "s string, target_share double, max_repeats bigint")
    chosen = mixing.choose(df, "k", "n", ["s", "l"], targets, "s", total=20_000)
    got = {r["s"]: r for r in mixing.shares(chosen, targets, "s").collect()}
    assert abs(got["big"]["actual_share"] - 0.8) < 0.01 and got["none"]["actual_tokens"] == 0
    assert chosen.agg(F.max(F.when(C("s") == "big", C("repeats")))).first()[0] == 1
    assert rows(chosen) == rows(mixing.choose(df.repartition(7), "k", "n", ["s", "l"], targets, "s", total=20_000))
    assert mixing.choose(df.limit(0), "k", "n", ["s", "l"], targets, "s").count() == 0


def test_any_number_of_leaves(spark):
    """Nothing is planned on the driver: a source for each document is no special case."""
    df = spark.range(5000).select(C("id").alias("k"), C("id").cast("string").alias("s"), F.lit("en").alias("l"), F.lit(3).alias("n"))
    targets = df.select("s", F.lit(1 / 5000).alias("target_share"), F.lit(2).cast("bigint").alias("max_repeats"))
    got = mixing.choose(df, "k", "n", ["l", "s"], targets, "s", total=30_000)
    assert got.count() == 5000 and got.agg(F.min("repeats")).first()[0] == 2


# --------------------------------------------------------------------------- subjects


def test_terms_of_a_text():
    n, found = subjects.find_terms("The OVEN – and l'oignon; the soup­ and the soups, kicked  off by the referee at the bank.")
    assert found["cooking"] == {"oven", "oignon", "soup"}
    assert found["sport"] == {"kicked off", "referee"} and found["finance"] == {"~bank"}  # a weak word, marked as such
    assert n == 18
    assert subjects.find_terms(None) == (0, {}) and subjects.find_terms("") == (0, {})
    assert subjects.find_terms("measured in kelvin")[1] == {"science": {"measured in kelvin"}}
    assert subjects.find_terms("The cllinic was badnaged")[1]["medicine"] == {"clinic", "bandaged"}
    assert subjects.find_terms("Das Bußgeld DIE RICHTERIN BUSSGELD")[1]["law"] == {"bussgeld", "richterin"}


def test_slips_of_the_first_letter():
    assert subjects.find_terms("andaged, the ontract; a lcinic")[1] == {"medicine": {"bandaged", "clinic"}, "law": {"contract"}}
    assert subjects.find_terms("an order, the article, enten")[1] == {}  # words themselves


def test_two_terms_make_a_subject(spark):
    data = [(1, "the soup and the oven"), (1, "the soup and the oven"), (2, "the soup, the soup"), (2, "the soup, the soup"), (3, None), (4, ""), (None, "soup oven"), (5, "soup oven " + "filler " * 5000)]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    assert rows(subjects.subjects_of(df, "doc_id", "text"), "doc_id", "subject") == [(1, "cooking"), (5, "cooking")]
    assert subjects.subjects_of(df.limit(0), "doc_id", "text").count() == 0


def test_held_out_labels(spark):
    """Calibrated on the even labelled documents, judged on the odd ones."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/doc_subjects.parquet")
    found = {tuple(r) for r in subjects.subjects_of(docs, "doc_id", "text", labels.filter("doc_id % 2 = 0")).select("doc_id", "subject").collect()}
    held = {tuple(r) for r in labels.filter("doc_id % 2 = 1").collect()}
    ids = {d for d, _ in held}
    said = {(d, s) for d, s in found if d in ids}
    assert len(said & held) / max(1, len(said)) > 0.9 and len(said & held) / max(1, len(held)) > 0.9


# Written after the term lists by the same hand, but from no table: a sentence a subject and language, and some about none.
UNSEEN = [
    ("cooking", "Fry the onion with garlic and cinnamon, then let it simmer with a tablespoon of flour."), ("cooking", "Steg løget på stegepanden og smag til med timian og persille."),
    ("cooking", "Das Rezept verlangt zwei Esslöffel Sahne, Zimt und eine heiße Bratpfanne."), ("cooking", "Faites mijoter les lentilles avec du thym et une cuillère à soupe d'huile."),
    ("finance", "The broker warned that inflation would eat the dividend of most shareholders."), ("finance", "Regnskabet viser en konkurs, og hver kreditor mister sin opsparingskonto."),
    ("finance", "Die Bilanz zeigt, dass Inflation und Einkommensteuer den Nettogewinn mindern."), ("finance", "La faillite inquiète chaque créancier, car la trésorerie est vide."),
    ("law", "The prosecutor read the indictment before the jury heard any testimony."), ("law", "Anklageren henviste til straffeloven, men forsvareren krævede en ny kendelse."),
    ("law", "Der Staatsanwalt verlas die Anklageschrift, dann sprach der Verteidiger."), ("law", "Le procureur cite le code pénal et l'avocat commence sa plaidoirie."),
    ("medicine", "The paediatrician prescribed an antibiotic after the ultrasound."), ("medicine", "Patienten fik insulin mod sin sukkersyge og blev målt for blodtryk."),
    ("medicine", "Nach der Narkose prüfte die Pflegerin den Blutdruck und gab Insulin."), ("medicine", "Le chirurgien posa le scalpel et vérifia l'anesthésie."),
    ("science", "Every isotope was measured by how fast its electron shells decayed near the catalyst."), ("science", "Astrofysik forklarer, hvordan en supernova former en stjernetåge."),
    ("science", "Das Teleskop zeigte eine Supernova in der fernen Galaxie."), ("science", "Le catalyseur agit sur la molécule pendant la photosynthèse."),
    ("software", "The unit test failed with a stack trace, so the deployment was stopped."), ("software", "Programmeringssproget har en compiler, og hver enhedstest kører på en webserver."),
    ("software", "Das Betriebssystem meldet Schadsoftware und eine Fehlermeldung im Quellcode."), ("software", "Le serveur web et la base de données tournent sous ce système d'exploitation."),
    ("sport", "The midfielder was offside in the quarter-final of the world cup."), ("sport", "Målmanden reddede i anden halvleg, og håndbold blev aftenens vinder."),
    ("sport", "Im Viertelfinale traf die Stürmerin kurz nach der Halbzeit."), ("sport", "La nageuse prépare le championnat, le gymnaste la coupe du monde."),
    ("transport", "A lorry blocked the roundabout and the tram had to wait in the traffic jam."), ("transport", "Godstoget holdt ved banegården, mens pendlere ventede på metrolinjen."),
    ("transport", "Der Güterzug fährt vom Hafen zum Bahnhof, der Lieferwagen steht im Verkehrsstau."), ("transport", "Le tramway relie l'aéroport au rond-point sans embouteillage."),
    (None, "She sat by the window and thought about her sister's letter."), (None, "Hun lagde nøglen på bordet og gik en tur."), (None, "Er kam spät nach Hause und las ein Buch."),
    (None, "Nous avons parlé longtemps de la pluie et du beau temps."), (None, "The bank of the river was steep, and the court of the castle lay in the sun."),
]


def test_texts_whose_words_were_not_seen(spark):
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(UNSEEN)], "doc_id bigint, text string")
    found = {tuple(r) for r in subjects.subjects_of(df, "doc_id", "text").select("doc_id", "subject").collect()}
    true = {(i, s) for i, (s, _) in enumerate(UNSEEN) if s}
    precision, recall = len(found & true) / len(found), len(found & true) / len(true)
    print(f"unseen texts: precision {precision:.2f}, recall {recall:.2f}")
    assert precision > 0.95 and recall > 0.6


def test_weights_decide_and_not_the_number_of_terms(spark):
    texts = ["the bank and its shares: a bond, an account, a charge of interest", "a tribunal in the court", "the tribunal heard a plaintiff", "the tribunal heard a plaintiff " + "and so on " * 40_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    scores = subjects.scored(subjects.match_terms(df, "doc_id", "text"), "doc_id")
    listed = {r["doc_id"] for r in scores.filter("n_terms >= 2").collect()}
    assert listed == {0, 1, 2, 3}
    assert {r["doc_id"] for r in subjects.subjects_of(df, "doc_id", "text").collect()} == {2, 3}
    # with the length normalisation on, two terms among 120,000 words say little
    assert {r["doc_id"] for r in scores.filter(subjects.score(0.2) > 1.2).collect()} == {2}


def test_frame_of_terms_is_clean():
    table = subjects.term_table()
    assert {s for s, _ in table.values()} == set(subjects.TERMS)
    weak = {w for w, (_, term) in table.items() if term.startswith("~")}
    assert {"bank", "court", "trial", "charge", "cell"} <= weak and not {"board", "letter"} & set(table)
    assert not [w for w in table if w in weak and table[w][1] != f"~{w}"]
