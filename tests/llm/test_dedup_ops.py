"""Exact, line and SimHash dedup against brute force, with their edge cases."""

import hashlib
import random
import re

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from civicmart.llm import exact_dedup, line_dedup, simhash_dedup
from civicmart.llm.common import sample_place, sample_steps, salted_join, sampled, scratch, stored
from civicmart.llm.components import components

SPACE = " \t\n\v\f\r"


def norm(t):
    return re.sub(f"[{SPACE}]", "", t or "")


def edge_rows():
    long = "word " * 30_000
    return [(1, "a b"), (2, "ab"), (3, " a\tb \n"), (4, None), (5, ""), (6, " \n\v"), (7, long),
            (8, long + " "), (9, "É b"), (10, "éb"), (11, "a b"), (11, "a b"), (None, "ab"),
            (12, "x y"), (13, "xy"), (None, "only here"), (-5, "neg"), (-4, "n eg")]


def brute_exact(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(norm(t), []).append((d, t))
    out = []
    for key, members in groups.items():
        best = max(members, key=lambda m: (len(m[1] or ""), m[0] is not None, -(m[0] or 0)))
        sha = hashlib.sha256(key.encode()).hexdigest()
        first = members.index(best)  # one row of the group stays, whatever repeats
        out += [(d, best[0], len(members), k == first, sha) for k, (d, _) in enumerate(members)]
    return sorted(out, key=str)


def test_one_row_of_a_group_stays_when_ids_and_texts_repeat(frame):
    rows = [(1, "a b"), (1, "a b"), (1, "a   b"), (None, "x y"), (None, "x y"), (None, " xy"), (None, "x\ty"),
            (5, "q"), (5, "q"), (None, "q"), (None, None), (None, "")]
    got = exact_dedup.exact_dedup(frame(rows)).collect()
    kept = [r for r in got if r.kept]
    assert len(got) == 12 and sorted((str(r.keep_id), r.group_size) for r in kept) == [
        ("1", 3), ("5", 3), ("None", 2), ("None", 4)]
    stay = [(r.doc_id, r.text) for r in exact_dedup.kept_documents(frame(rows)).collect()]
    assert len(stay) == 4 and (1, "a   b") in stay and (5, "q") in stay
    assert sum(t in ("x y", "x\ty", " xy") for _, t in stay) == 1


def test_a_chain_is_walked_by_bytes(frame, monkeypatch):
    """All texts share one hash: the rows find their entries by their bytes alone."""
    real = F.xxhash64
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(7).cast("long") if c == ("norm",) else real(*c))
    rows = [(i, t) for i, t in enumerate(["one", "two", "o ne", "three", None, " ", "t w o", "three"])]
    got = sorted((tuple(r) for r in exact_dedup.exact_dedup(frame(rows)).collect()), key=str)
    assert got == brute_exact(rows)


def test_exact_dedup_equals_brute_force(frame):
    rows = edge_rows()
    got = [tuple(r) for r in exact_dedup.exact_dedup(frame(rows)).collect()]
    assert sorted(got, key=str) == brute_exact(rows)


def test_exact_dedup_of_an_empty_table(frame):
    assert exact_dedup.exact_dedup(frame([])).collect() == []
    assert exact_dedup.kept_documents(frame([])).collect() == []


def test_directory_doubles_and_buckets_split(frame):
    docs = frame([(i, f"text number {i}") for i in range(300)])
    index = exact_dedup.build_index(docs, bucket_rows=16)
    assert index.depth >= 4
    sizes = {r.bucket: r["count"] for r in index.entries.groupBy("bucket").count().collect()}
    assert sum(sizes.values()) == 300 and max(sizes.values()) <= 16
    directory = index.directory.collect()
    assert len(directory) == 1 << index.depth  # every prefix has its bucket
    assert {r.bucket for r in directory} >= set(sizes)


def test_a_second_batch_extends_the_index(frame):
    first = exact_dedup.build_index(frame([(1, "a b"), (2, "c")]))
    both = exact_dedup.build_index(frame([(3, "a   b"), (4, "d")]), earlier=first)
    got = {(r.keep_id, r.group_size) for r in both.entries.collect()}
    assert got == {(3, 2), (2, 1), (4, 1)}


def test_hash_collisions_chain(frame, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    rows = [(1, "one"), (2, "two"), (3, "o ne")]
    index = exact_dedup.build_index(frame(rows))
    assert sorted(r.chain for r in index.entries.collect()) == [0, 1]
    monkeypatch.undo()


def test_kept_documents_keeps_the_columns(frame):
    docs = frame(edge_rows())
    out = exact_dedup.kept_documents(docs)
    assert out.columns == docs.columns
    assert {(r["_keep"], r["_h"], r["_flagged"]) for r in out.collect()} == {("y", "h", "f")}
    kept = sorted(str((r.doc_id, r.text)) for r in out.collect())
    want = {norm(t): None for _, t in edge_rows()}
    assert {norm(eval(k)[1]) for k in kept} == set(want)  # every text once, none lost


def brute_lines(rows, least=10):
    key = lambda line: line.strip(SPACE).translate({c: c + 32 for c in range(65, 91)})
    big = 1 << 63
    owner = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                d_ = big if d is None else d
                owner[key(line)] = min(owner.get(key(line), d_), d_)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least
                or owner[key(x)] == (big if d is None else d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


LINES = ["A common line here", "a COMMON line here  ", "\ta common line here", "short", "",
         "ÉCLAIR au chocolat", "éclair au chocolat", "another shared line", "ten chars.", "nine char"]


def test_runs_are_joined_without_moving_them(corpus, frame):
    """The plan of a later batch shuffles the batch, never a run."""
    rows = [(d, "\n".join(f"a line of number {k}" for k in range(d, d + 5))) for d in range(40)]
    lines = line_dedup.long_lines(frame(rows)).select("id", "h1", "h2")
    index = line_dedup.LineIndex(corpus, 8)
    index.add(lines.where("id < 20"))
    index.add(lines.where("id >= 20 AND id < 30"))
    plan = index.unknown(lines.where("id >= 30"))._jdf.queryExecution().executedPlan().toString()
    names = index.runs()
    assert len(names) == 2
    text = plan.splitlines()
    for name in names:
        (at,) = [k for k, line in enumerate(text) if name in line]
        depth = text[at].index("FileScan")
        above = []
        for line in reversed(text[:at]):  # the operators between the scan and its join
            place = len(line) - len(line.lstrip(" :+-*"))
            if place < depth:
                depth = place
                above.append(line)
                if "SortMergeJoin" in line:
                    break
        assert not any("Exchange" in line for line in above), above
        assert "Bucketed: true" in text[at]


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_line_dedup_equals_brute_force(frame, batches):
    rng = random.Random(batches)
    rows = [(i, "\n".join(rng.choices(LINES + [f"unique line {i} {j}" for j in range(3)],
                                      k=rng.randint(1, 12)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, "a common line here\nshort"), (None, None),
             (5_000, "unique line 3 1\n" * 5_000), (7, LINES[0] + "\nshort")]
    got = sorted((tuple(r) for r in line_dedup.line_dedup(frame(rows), batches=batches).collect()),
                 key=str)
    assert got == brute_lines(rows)


def test_line_dedup_of_an_empty_table(frame):
    assert line_dedup.line_dedup(frame([])).collect() == []


def test_a_continued_index_drops_lines_of_earlier_documents(frame, corpus):
    rng = random.Random(12)
    rows = [(i, "\n".join(rng.choices([f"line number {j}" for j in range(60)] + LINES, k=4)))
            for i in range(45)]
    rows += [(45, "held by no one else\nline number 1"), (None, "held by no one else\nown line, no id")]
    index, got = line_dedup.LineIndex(corpus, 4), []
    for part in (rows[:20], rows[20:40], rows[40:], []):
        got += line_dedup.line_dedup(frame(part), batches=2, index=index).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_lines(rows)


def colliding_lines():
    """Two lines of 16 letters with the same XXH64 of seed 42: the second word is solved for."""
    p1, p2, p4, p5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
    m = (1 << 64) - 1
    rotl = lambda x, r: (x << r | x >> 64 - r) & m
    mix = lambda x: rotl(x * p2 & m, 31) * p1 & m
    unmix = lambda y: rotl(y * pow(p1, -1, 1 << 64) & m, 33) * pow(p2, -1, 1 << 64) & m
    first = lambda x: (rotl((42 + p5 + 16 & m) ^ mix(x), 27) * p1 + p4) & m
    word = lambda b: int.from_bytes(b, "little")
    line, rng = b"the line to meet", random.Random(1)
    want = first(word(line[:8])) ^ mix(word(line[8:]))
    while True:
        head = bytes(rng.choices(range(97, 123), k=8))
        tail = unmix(want ^ first(word(head))).to_bytes(8, "little")
        if all(32 < c < 127 and not 65 <= c <= 90 for c in tail):
            return line.decode(), (head + tail).decode()


def test_lines_that_collide_in_one_hash_are_told_apart(frame):
    a, b = colliding_lines()
    assert a != b and xxhash.xxh64_intdigest(a, 42) == xxhash.xxh64_intdigest(b, 42)
    rows = [(1, a), (2, b), (3, f"{a}\n{b}")]
    assert sorted(tuple(r) for r in line_dedup.line_dedup(frame(rows)).collect()) == brute_lines(rows)


def test_runs_are_compacted_and_disjoint(frame, corpus):
    index = line_dedup.LineIndex(corpus, 4)
    line_dedup.line_dedup(frame([(i, f"the shared line\nown line of {i}") for i in range(60)]),
                          batches=9, index=index)
    assert all(len(level) < line_dedup.FANOUT for level in index.levels) and len(index.levels) > 1
    keys = index.owners().select("h1", "h2")
    assert keys.count() == keys.distinct().count() == 61


def brute_simhash(text, k=3):
    words = re.findall(f"[^{SPACE}]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_of_whole_texts():
    rng = random.Random(1)
    for text in [None, "", " \t", "One", "one TWO", "A b C d É é", "x " * 200_000,
                 *[" ".join(rng.choices("a b c Dd e É".split(" "), k=n)) for n in (3, 4, 50)]]:
        if len(text or "") < 1000:
            assert simhash_dedup.simhash(text) == brute_simhash(text)
    assert simhash_dedup.simhash("x " * 200_000) == xxhash.xxh64_intdigest("x x x", 42)


def brute_components(values, radius):
    todo, out = set(values), {}
    while todo:
        group, stack = set(), [min(todo)]
        while stack:
            v = stack.pop()
            if v in group:
                continue
            group.add(v)
            stack += [w for w in todo if (v ^ w).bit_count() <= radius and w not in group]
        todo -= group
        out |= {v: min(group) for v in group}
    return out


@pytest.mark.parametrize("agree,nodes", [(1, 1000), (1, 7), (2, 7), (3, 1000)])
def test_links_connect_as_all_pairs_do(corpus, agree, nodes):
    rng = random.Random(5)
    values = {0}
    for _ in range(12):  # chains of neighbours, all within few blocks
        v = rng.getrandbits(64)
        for _ in range(20):
            v ^= sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 3)))
            values.add(v % 2**64)
    signed = [v - 2**64 if v >> 63 else v for v in values]
    got = simhash_dedup.links(corpus.createDataFrame([(v,) for v in signed], "fp long"), 2, nodes, agree)
    pairs = {(r.a % 2**64, r.b % 2**64) for r in got.collect()}
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert {v: root(v) for v in values} == brute_components(values, 2)


def test_bk_tree_finds_all_within_the_radius():
    rng = random.Random(2)
    values = [rng.getrandbits(10) for _ in range(300)]
    tree = simhash_dedup.BKTree(values)
    for q in range(0, 1024, 37):
        for r in (0, 1, 2, 4):
            assert sorted(tree.within(q, r)) == sorted({v for v in values if (v ^ q).bit_count() <= r})


@pytest.mark.parametrize("small", [0, 1 << 40])
def test_queries_down_a_tree_together_find_what_each_finds(monkeypatch, small):
    monkeypatch.setattr(simhash_dedup, "SMALL_SEARCH", small)
    monkeypatch.setattr(simhash_dedup, "QUERY_BLOCK", 50)
    rng = random.Random(4)
    wide = [rng.getrandbits(64) - 2**63 for _ in range(200)]
    wide += [v ^ (1 << rng.randrange(63)) for v in wide]
    for values, queries in [(wide, wide[::3] + [0, -1]), ([5], [4, 5, 12]), ([], [1]), ([1, 2], [])]:
        tree = simhash_dedup.BKTree(values)
        for r in (0, 1, 2, 20):
            want = sorted((q, v) for q in queries for v in set(values) if simhash_dedup.distance(q, v) <= r)
            assert sorted(tree.search(queries, r)) == want


def test_a_tree_is_built_once_for_all_its_queries(monkeypatch):
    rows = [(0, 7, 0, False, [0, 1, 64]), (0, 7, 0, True, [3]), (0, 7, 0, True, [128, 1 << 20]),
            (0, 7, 1, True, [128]),  # no values of its own
            (0, 7, 2, False, [9, 1 << 40])]
    built, init = [], simhash_dedup.BKTree.__init__
    monkeypatch.setattr(simhash_dedup.BKTree, "__init__",
                        lambda self, values: (built.append(list(values)), init(self, values))[1])
    names = ["block", "value", "tree", "asks", "fps"]
    tables = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in part])
              for part in (rows[:2], rows[2:])]
    got = [(r["a"], r["b"]) for t in simhash_dedup.search_trees(iter(tables), 2) for r in t.to_pylist()]
    assert [b for b in built if b] == [[0, 1, 64], [9, 1 << 40]]
    assert {0, 1, 3, 64, 128, 1 << 20} == {v for pair in got for v in pair}
    assert all(simhash_dedup.distance(a, b) <= 2 for a, b in got)


def test_simhash_dedup_equals_brute_force(frame):
    rng = random.Random(3)
    base = [" ".join(rng.choices([f"w{i}" for i in range(300)], k=400)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t.replace(t.split()[200], "Changed", 1)) for i, t in enumerate(base)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, base[0].upper()), (50, base[1]), (None, base[2])]
    fps = {d: brute_simhash(t) for d, t in rows}
    roots = brute_components(set(fps.values()), 2)
    least = {}
    for d, v in fps.items():
        if d is not None:
            least[roots[v]] = min(least.get(roots[v], d), d)
    want = sorted(((d, f"{v:016x}", least[roots[v]]) for d, v in fps.items()), key=str)
    docs = frame(rows)
    assert sorted((tuple(r) for r in simhash_dedup.simhash_dedup(docs).collect()), key=str) == want
    stay = simhash_dedup.one_of_each(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted(set(least.values()))


def test_one_row_stands_for_each_component(frame):
    rng = random.Random(13)
    a, b, c, d = (" ".join(rng.choices([f"w{i}" for i in range(300)], k=400)) for _ in range(4))
    near = a.replace(a.split()[200], "Changed", 1)
    assert (brute_simhash(a) ^ brute_simhash(near)).bit_count() <= 2
    rows = [(5, a), (None, near), (None, a),                # goes: near copies of a kept document
            (None, b), (None, b.upper()), (None, b),        # only null ids: one row
            (None, c),                                      # another such component
            (6, d), (6, near), (6, d.upper()), (7, d)]      # 6 stands for d alone, once
    docs = frame(rows)
    stay = simhash_dedup.one_of_each(docs)
    assert stay.columns == docs.columns
    got = sorted(((r.doc_id, r.text.lower()) for r in stay.collect()), key=str)
    assert got == sorted([(5, a), (None, b), (None, c), (6, d)], key=str)
    unique = frame([(5, a), (6, near), (None, c)])
    assert sorted((r.doc_id for r in simhash_dedup.one_of_each(unique).collect()), key=str) == [5, None]


def test_simhash_dedup_of_an_empty_table(frame):
    assert simhash_dedup.simhash_dedup(frame([])).collect() == []


def test_components_of_paths_stars_and_cycles(corpus):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + k) for k in range(1, 900)]
    edges += [(70, 71), (71, 72), (72, 70), (80, 80)]
    got = dict(components(corpus.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(1, 51))
    assert all(got[1000 + k] == 1000 for k in range(1, 900)) and got[71] == got[72] == 70


def test_a_sample_has_the_share_asked_for(corpus):
    rows = corpus.range(20_000).withColumnRenamed("id", "doc_id")
    got = sampled(rows, 2_000, "s")
    assert 1_800 < got.count() < 2_200
    assert sorted(got.collect()) == sorted(sampled(rows.repartition(7), 2_000, "s").collect())
    assert sampled(rows, 20_000, "s").count() == 20_000
    many = corpus.range(5 * 10**7).withColumnRenamed("id", "doc_id")
    # as part of a table so large that the share is below 2^-20
    assert 5 < many.where(sample_place(many, "s") < sample_steps(4 * 10**5, 10**12)).count() < 50


def test_repeated_rows_neither_empty_nor_flood_a_sample(corpus):
    """One row makes up a third, or all, of the table: bounded on every seed, and never nothing."""
    for others in (100_000, 0):
        rows = corpus.range(50_000).selectExpr("7L AS doc_id", "'en' AS lang").unionByName(
            corpus.range(others).selectExpr("id AS doc_id", "if(id % 50 = 0, 'xx', 'de') AS lang"))
        for seed in "abcde":
            assert 100 <= sampled(rows, 1_000, seed).count() <= 2_000
            by = sampled(rows, 900, seed, by="lang")
            got = {r.lang: r["count"] for r in by.groupBy("lang").count().collect()}
            assert set(got) == ({"en", "de", "xx"} if others else {"en"}) and max(got.values()) <= 2_000


def test_salted_join_neither_loses_nor_repeats(corpus):
    left = corpus.range(5_000).select(F.when(F.col("id") < 4_000, 1).otherwise(F.col("id")).alias("k"), "id")
    groups = stored(left.groupBy("k").agg(F.count(F.lit(1)).alias("n")), scratch(corpus, "t"))
    out = salted_join(left, groups, ["k"], "n", 5_000, F.col("id"))
    assert out.count() == 5_000 and out.where("n IS NULL").count() == 0
    assert out.where("k = 1 AND n = 4000").count() == 4_000
