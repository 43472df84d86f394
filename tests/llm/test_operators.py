"""Each operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, and against brute force."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lectern.llm import chat_format, decontaminate, html_extract, license_scan, line_dedup, packing, quality_classifier, quality_rules, simhash, toxicity
from lectern.llm.common import release, repeated_words, text_stats
from tests.conftest import DATA

DOCS = "doc_id bigint, text string, lang string, source string, score double, fingerprint string, n_words int, h int, place int"
LONG = "slow words make a very long text " * 3000


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, "en", "s", 0.5, "f", 1, 2, 3) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, (1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x y z w v"), (4, LONG), (5, "é Ünï\x0b\x0c tab\t* # <b>"), (6, "\n\n"))


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark)


def by_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# 1. decontamination


def brute_contamination(text, items):
    w = by_words(text)
    hit, found = set(), set()
    for item, body in items:
        b = by_words(body)
        k = min(10, len(b))
        for s in range(len(b) - k + 1) if b else ():
            for p in range(len(w) - k + 1):
                if w[p : p + k] == b[s : s + k]:
                    hit.update(range(p, p + k))
                    found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block", [200_000, 3])
def test_decontamination_against_brute_force(spark, block):
    rng = random.Random(3)
    vocabulary = ["of", "the", "Stone", "river", "día", "42"]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(1, line(14)), (2, line(3)), (3, None), (4, "!!"), (5, line(10)), (5, line(12))]
    bodies = [t for _, t in items if t]
    texts = [(i, line(rng.randrange(0, 40)) + (", " + rng.choice(bodies) if i % 2 else "")) for i in range(30)]
    texts += [(90, None), (91, ""), (92, items[0][1]), (92, items[0][1]), (None, items[1][1])]
    d = spark.createDataFrame(texts, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.find_hits(d, b, block_windows=block).collect())
    assert got == sorted((i if i is not None else -1, *brute_contamination(t, items)) for i, t in texts)


def test_decontamination_odd_rows(spark, odd, empty):
    b = spark.createDataFrame([(1, "a b c"), (None, "zz")], "item_id bigint, text string")
    assert decontaminate.decontaminate(odd, b).count() == 8
    assert decontaminate.decontaminate(empty, b).count() == 0
    assert decontaminate.decontaminate(odd, b.limit(0)).where("contaminated").count() == 0
    left = decontaminate.drop_contaminated(odd, b)
    assert left.columns == odd.columns and left.count() == 6


def test_decontamination_runs_no_python(spark, odd):
    plan = decontaminate.decontaminate(odd, spark.createDataFrame([(1, "a b c")], "item_id bigint, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# 2. licenses


def test_license_templates_are_found_exactly():
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    for name, template in license_scan.TEMPLATES.items():
        found = scanner.scan(f"Some words before.\n{template}\nSome words after.")
        assert (name, True) in {(x[2], x[5]) for x in found}, (name, found)


def test_license_small_changes_and_none(spark, odd, empty):
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    changed = license_scan.TEMPLATES["mit"].replace("free of charge", "free of cost")
    (start, end, name, reduction, n, exact), *more = scanner.scan(changed)
    assert (name, n, exact, more) == ("mit", 1, False, []) and reduction > 0.5
    assert scanner.scan("The driver lost the license. Permission to land was given.") == []
    assert license_scan.scan_licenses(odd).count() == 0 and license_scan.scan_licenses(empty).count() == 0
    both = docs(spark, (1, "All rights reserved.\nReleased under the MIT License."), (1, "All rights reserved."), (2, None))
    assert sorted((r.doc_id, r.license) for r in license_scan.scan_licenses(both).collect()) == [(1, "all-rights-reserved"), (1, "all-rights-reserved"), (1, "mit-line")]


def test_licenses_against_plain_search(spark):
    """Every place where a template's words stand in a row, in the generated documents and in planted ones, is within a notice that is found; and the others hold none."""
    rng = random.Random(16)
    known = license_scan.TEMPLATES
    planted = []
    for k in range(60):
        parts = [f"{prose(rng, rng.randrange(0, 60))}{rng.choice(['. ', chr(10), ' '])}{known[n]}" for n in rng.sample(sorted(known), rng.randrange(0, 4))]
        planted.append((100_000 + k, chr(10).join([*parts, prose(rng, 30)])))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()] + planted
    scanner, found, total = license_scan.Scanner(known), 0, 0
    for _, text in rows:
        got = scanner.scan(text)
        own = license_scan.words(text)
        for name, template in known.items():
            words = license_scan.words(template)
            spots = [i for i in range(len(own) - len(words) + 1) if own[i : i + len(words)] == words]
            total += len(spots)
            here = [g for g in got if g[2] == name or set(license_scan.words(known[g[2]])) >= set(words)]
            found += min(len(spots), len(here))
            assert bool(here) == bool(spots) or any(not g[5] for g in here) or any(set(license_scan.words(known[g[2]])) > set(words) for g in here)
    assert total > 80 and found == total


def test_a_long_block_with_many_notices():
    text = " ".join(f"{license_scan.TEMPLATES['mit-line']} {'word' * 9} {k}." for k in range(3000)) + "x" * 1_000_000
    began = time.process_time()
    assert sum(g[2] == "mit-line" for g in license_scan.Scanner(license_scan.TEMPLATES).scan(text)) == 3000
    assert time.process_time() - began < 20


# 3. packing


def test_ids_are_those_of_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    encode = packing.encoder()
    for text in ["Hello  world\n\n x", "día ñandú 漢字 😀", " ", "a" * 300, "\x00\x01", "it's <|endoftext|> 12345"]:
        assert encode(text) == t.encode(text, add_special_tokens=False).ids


def test_ids_of_long_blank_runs():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    encode = packing.encoder()
    for text in (" " * 2_000_000 + "x", "a" + "\n" * 2_000_000, "b c" + " \u00a0" * 60_000 + "<|endoftext|>", "\n" * packing.LONGEST_BLANK + "x"):
        assert encode(text) == t.encode(text, add_special_tokens=False).ids


def test_shares_of_a_length_and_repeated_rows(spark):
    d = spark.range(600).select((F.col("id") % 3).alias("doc_id"), F.lit("the same short text").alias("text")).union(spark.createDataFrame([(9, "another " * 700)], "doc_id bigint, text string"))
    got = packing.assign(packing.tokenize(d), rows_a_share=7).collect()
    places = sorted((r.sequence_id, r.offset, r.length) for r in got)
    ends = {}
    for s, o, n in places:
        assert o == ends.get(s, 0)
        ends[s] = o + n
    assert len(got) == len(set((s, o) for s, o, _ in places)) and max(ends.values()) <= 1024 and len(ends) == -(-sum(n for *_, n in places) // 1024)


def test_pieces():
    assert packing.pieces_of(1024, 1024) == [(0, 1024)]
    assert packing.pieces_of(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)]
    assert packing.pieces_of(2048, 1024) == [(0, 1024), (1024, 1024)]


def optimum(lengths, limit):
    """The fewest bins, by trying every bin for every item."""
    best = [len(lengths)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= limit:
                bins[k] += lengths[i]
                put(i + 1, bins)
                bins[k] -= lengths[i]
        put(i + 1, [*bins, lengths[i]])

    put(0, [])
    return best[0]


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(5)
    for _ in range(60):
        lengths = sorted((rng.randrange(1, 21) for _ in range(9)), reverse=True)
        counts = {x: lengths.count(x) for x in lengths}
        made = packing.bin_completion(counts, 20)
        used = {}
        for k, content in made:
            assert sum(content) <= 20
            for x in content:
                used[x] = used.get(x, 0) + k
        assert used == counts
        assert sum(k for k, _ in made) == optimum(lengths, 20)


def test_packing_is_whole_and_gapless(spark, odd, empty):
    got = packing.pack(odd).collect()
    encode = packing.encoder()
    whole = {}
    for r in got:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        whole.setdefault((r.doc_id, r.piece), []).append(r)
    for i, text in [(1, ""), (4, LONG), (None, "x y z w v")]:
        ids = [x for r in sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece) for x in r.ids]
        assert ids == [*encode(text), 2]
    assert len(whole[(3, 0)]) == 2
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(places) == -(-sum(r.length for r in got) // 1024)
    assert packing.pack(empty).count() == 0
    assert packing.sequences(packing.pack(odd)).select(F.max(F.size("ids"))).first()[0] <= 1024


# 4. lines


def words_like(rng, n):
    return [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau".split()) + rng.choice(["", "", "", "", ".", "!", "…"]) for _ in range(n)]


def masked(text):
    return [["<*>" if re.search("[0-9]", w) else w for w in x.split()] for x in text.split("\n")]


def brute_templates(rows):
    """(row, first token, number) of what the tree of lines and sentences takes: templates by pairs; recurring ones stay first in the smallest hash's row."""
    key = {i: (xxhash.xxh64_intdigest(t.encode(), xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42)) + (1 << 63)) % (1 << 64) for i, t in rows}
    lines, sentences = [], []
    for i, t in rows:
        at = 0
        for w in masked(t):
            lines += [(i, at, tuple(w))] if len(w) >= 3 else []
            first = 0
            for k, x in enumerate(w):
                if x[-1] in ".!?…" or k == len(w) - 1:
                    sentences += [(i, at + first, tuple(w[first : k + 1]))] if k + 1 - first >= 8 else []
                    first = k + 1
            at += len(w)
    forms = sorted({f for *_, f in lines})
    root = {f: f for f in forms}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for x in forms:
        for y in forms:
            if x < y and len(x) == len(y) >= 12 and x[:3] == y[:3]:
                cuts = [3 + (len(x) - 3) * k // 4 for k in range(5)]
                if sum(x[cuts[k] : cuts[k + 1]] != y[cuts[k] : cuts[k + 1]] for k in range(4)) == 1:
                    root[find(x)] = find(y)
    gone = set()
    for units, group, enough in ((lines, find, lambda g: len(g[0][2]) >= 12 or len({(i, f) for i, _, f in g}) >= 10), (sentences, lambda f: f, lambda g: True)):
        groups = {}
        for u in units:
            groups.setdefault(group(u[2]), []).append(u)
        for g in groups.values():
            if len({i for i, *_ in g}) > 1 and enough(g):
                keeper, had = min({i for i, *_ in g}, key=key.get), set()
                for i, at, f in sorted(g):
                    gone |= {(i, at, len(f))} if i != keeper or (i, f) in had else set()
                    had.add((i, f))
    return gone


def brute_grams(rows):
    """Tokens in runs of 12 that stand in two rows; and those that a run of 39 or more equal tokens of two rows holds."""
    tokens = {i: [x for line in masked(t) for x in line] for i, t in rows}
    seen = {}
    for i, w in tokens.items():
        for k in range(len(w) - 11):
            seen.setdefault(tuple(w[k : k + 12]), set()).add(i)
    may = {i: {p for k in range(len(w) - 11) if len(seen[tuple(w[k : k + 12])]) > 1 for p in range(k, k + 12)} for i, w in tokens.items()}
    return tokens, may


@pytest.mark.parametrize("limits", [{}, {"task_rows": 0, "broadcast_rows": 0, "broadcast_bytes": 0, "hot": 5}])
def test_line_dedup_against_brute_force(spark, limits):
    rng = random.Random(11)
    shared = [" ".join(words_like(rng, n)) for n in (14, 20, 55)] + ["Page 3 of the long report on the state of all the rivers here", "short line here"]
    rows = []
    for i in range(40):
        own = [" ".join(words_like(rng, rng.randrange(1, 26))) for _ in range(3)]
        for s in rng.sample(shared, 2) if i % 5 else shared:
            w = s.replace("3", str(i)).split()
            if rng.random() < 0.4 and len(w) > 12:
                w[rng.randrange(3, len(w))] = f"other{rng.choice(w)}"
            own.insert(rng.randrange(3), " ".join(w))
        rows.append((i, "\n".join(own)))
    passage = words_like(rng, 70)
    for i in range(40, 52):  # whole or in part, wrapped in several ways, within other words
        a, b = rng.randrange(0, 16), rng.randrange(55, 71)
        part = passage[a:b]
        step = rng.choice([9, 17, 80])
        wrapped = "\n".join(" ".join(part[k : k + step]) for k in range(0, len(part), step))
        rows.append((i, f"{' '.join(words_like(rng, 20))} {wrapped} {' '.join(words_like(rng, 9))}\n{' '.join(words_like(rng, 5))}"))
    got = {r.doc_id: r.text for r in line_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id bigint, text string"), **limits).collect()}
    tokens, may = brute_grams(rows)
    units = brute_templates(rows)
    for i, t in rows:
        take = {p for d, at, n in units if d == i for p in range(at, at + n)}
        raw, left = t.split(), got[i].split()
        ways = {0}  # numbers of tokens left so far, over all ways to take out what must go and nothing but what may
        for p, word in enumerate(raw):
            ways = (ways if p in take | may[i] else set()) | {q + 1 for q in ways if p not in take and q < len(left) and left[q] == word}
        assert len(left) in ways, i
    whole = [" ".join(passage[k : k + 39]) for k in range(len(passage) - 38)]
    assert all(sum(w in " ".join(t.split()) for t in got.values()) <= 1 for w in whole)


def test_line_dedup_odd_rows(spark, odd, empty):
    out = line_dedup.dedup_passages(odd.withColumns({"n_lines": F.lit("x"), "__gone": F.lit(7)}).drop("__gone"))
    assert out.columns == [*odd.columns, "n_lines", "n_dropped", "n_cut"] and out.count() == 8 and out.where("n_dropped + n_cut > 0").count() == 0
    assert out.where("text is null").first().n_lines == 0 and {(r.doc_id, r.text) for r in out.collect()} == {(r.doc_id, r.text) for r in odd.collect()}
    assert line_dedup.dedup_passages(empty).count() == 0


def test_tokens_and_hashes_against_plain_ones():
    rng = random.Random(12)
    bodies = ["".join(rng.choice(["a", "é", "b7", " ", "\n", "\t", ". ", "…", " x", "漢"]) for _ in range(rng.randrange(0, 60))).encode() for _ in range(40)] + [b"", b"x" * 900_000 + b" y z " * 200_000]
    tokens = line_dedup.Tokens(bodies)
    plain = [w for b in bodies for w in b.split()]
    assert np.diff(tokens.at).tolist() == [len(b.split()) for b in bodies] and tokens.stop.tolist() == [w.endswith((b".", b"!", b"?", "…".encode())) for w in plain]
    at = np.arange(len(plain))
    codes = tokens.hash(at, at + 1, np.uint64(0)).tolist()
    mask = [b"<*>" if re.search(rb"[0-9]", w) else w for w in plain]
    assert len(set(zip(codes, mask, strict=True))) == len(set(codes)) == len(set(mask))
    a, b = line_dedup.Tokens([b"x y one two three"]), line_dedup.Tokens([b"one  two\nthree z"])
    assert a.hash(np.array([2]), np.array([5]), np.uint64(1)) == b.hash(np.array([0]), np.array([3]), np.uint64(1)) != b.hash(np.array([1]), np.array([4]), np.uint64(1))


# 5. rules


def brute_repeat(words, width=5):
    seen = {}
    for i in range(len(words) - width + 1):
        seen.setdefault(tuple(words[i : i + width]), []).append(i)
    return len({k for v in seen.values() if len(v) > 1 for i in v for k in range(i, i + width)})


def test_text_stats_against_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(["a ", "b\n", "é#\t", "A!", "<x> ", "\x0b", "a b a b a "]) for _ in range(rng.randrange(60)))
        s = text_stats(text.encode())
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert s[:5] == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:k] for k, x in enumerate(lines)), brute_repeat(words))
    assert repeated_words(np.arange(10_000) % 7000, 7000) == brute_repeat([k % 7000 for k in range(10_000)])


def test_rules_reject_outliers_and_keep_the_rest(spark, odd, empty):
    rng = random.Random(2)
    prose = lambda n: " ".join(rng.choice(["stone", "river", "walks", "green", "under", "seven", "Later", "often", "house"]) + rng.choice(["", "s", "ly", "ed", "ing"]) for _ in range(n)) + "."
    rows = [(i, prose(rng.randrange(40, 300))) for i in range(300)] + [(1000 + i, " ".join(w + "###" for w in prose(80).split())) for i in range(8)]
    got = {r.doc_id: r for r in quality_rules.apply_rules(docs(spark, *rows)).collect()}
    assert len(got) == 308 and not any(got[1000 + i].kept for i in range(8))
    assert sum(got[i].kept for i in range(300)) == 300
    out = quality_rules.apply_rules(odd)
    assert out.count() == 8 and out.where("doc_id in (1, 2, 3)").where("kept").count() == 0
    assert quality_rules.apply_rules(empty).count() == 0
    nulls = spark.createDataFrame([(1, prose(50), None, None)], "doc_id bigint, text string, lang string, source string")
    assert quality_rules.apply_rules(nulls).first().kept


def plain_mcd(x, rng):
    """FAST-MCD with floors: 300 random starts of 7 rows, concentration steps to the end, the least determinant."""
    floor = np.diag(np.square(quality_rules.FLOORS))
    near = -(-len(x) * 3 // 4)
    best = None
    for _ in range(300):
        own = x[rng.choice(len(x), 7, replace=False)]
        last = None
        while True:
            mean, cov = own.mean(0), np.cov(own.T, bias=True) + floor
            det = np.linalg.slogdet(cov)[1]
            if len(own) == near:
                if last is not None and det >= last - 1e-9:
                    break
                last = det
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            own = x[np.argsort(d, kind="stable")[:near]]
        if best is None or last < best[0]:
            best = (last, mean, cov)
    return best


@pytest.mark.parametrize("limits", [{"broadcast_groups": 20_000, "task_rows": 100_000, "hot": 10_000}, {"broadcast_groups": 0, "task_rows": 0, "hot": 3}])
def test_least_determinants_against_many_starts(spark, limits):
    rng = np.random.default_rng(5)
    groups, rows = {}, []
    for g, (n, share) in enumerate([(200, 0.0), (160, 0.2), (60, 0.15), (400, 0.24)]):
        mix = rng.normal(size=(6, 6)) * 0.15
        x = rng.normal(size=(n, 6)) @ mix + rng.normal(size=6)
        bad = int(share * n)
        x[:bad] += rng.normal(size=6) * 3  # outliers side by side, the hard case
        groups[f"g{g}"] = (x, bad)
        rows += [(f"g{g}", *map(float, r)) for r in x]
    df = spark.createDataFrame(rows, "key string, " + ", ".join(f"x{i} double" for i in range(6))).repartition(3)
    got = {r.key: r for r in quality_rules.estimates(df, limits).collect()}
    groups["*"] = (np.concatenate([x for x, _ in groups.values()]), 0)
    assert set(got) == set(groups)
    for key, (x, bad) in groups.items():
        r = got[key]
        det, mean, cov = plain_mcd(x, rng)
        assert r.uses == len(x) and (key == "*" or r.det0 <= det + 0.15), (key, r.det0, det)
        mine = np.array([r[f"m0_{i}"] for i in range(6)])
        cov0 = quality_rules._covariance(np.zeros(6), [r[f"c0_{i}_{j}"] for i, j in quality_rules._PAIRS]) + np.diag(np.square(quality_rules.FLOORS))
        d = np.einsum("ij,jk,ik->i", x - mine, np.linalg.inv(cov0), x - mine)
        assert not bad or d[:bad].min() > np.quantile(d[bad:], 0.99)


def test_verdicts_are_the_same_on_both_sides_of_the_limits(spark):
    d = spark.read.parquet(f"{DATA}/documents.parquet")
    plain = {r.doc_id: r for r in quality_rules.apply_rules(d).collect()}
    dealt = {r.doc_id: r for r in quality_rules.apply_rules(d, broadcast_groups=0, task_rows=0, hot=5).collect()}
    assert plain.keys() == dealt.keys() and all(plain[k].kept == dealt[k].kept for k in plain)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    good = [plain[k].kept for k, q in labels.items() if q == 1]
    bad = [plain[k].kept for k, q in labels.items() if q == 0]
    assert sum(good) > 0.95 * len(good) and sum(bad) < 0.2 * len(bad)


# 6. chats


def read(formatted):
    """An independent reading of the template."""
    back = lambda x: re.sub(r"\\[blg]", lambda m: {"\\b": "\\", "\\l": "<", "\\g": ">"}[m[0]], x)
    return [(back(r), back(t)) for r, t in re.findall(r"<turn ([^>]*)>([^<]*)</turn>\n", formatted)]


def test_chat_windows_read_back(spark):
    rng = random.Random(9)
    words = ["plain", "\\", "<turn user>", "</turn>", "\\l", "\\b<", ">", "é", "\n", "</turn>\n"]
    rows = []
    for c in range(12):
        for t in range(rng.randrange(1, 30)):
            role = "system" if t == 0 and c % 2 else rng.choice(["user", "assistant", "assistant", None, "to<ol>"])
            rows.append((c, t if t != 3 else None, role, None if rng.random() < 0.1 else " ".join(rng.choice(words) for _ in range(rng.randrange(60)))))
    rows += [(None, 0, "assistant", "x"), (50, 1, "assistant", "same"), (50, 1, "assistant", "same"), (51, 0, "user", "y" * 9000), (51, 1, "assistant", "z" * 9000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    windows = chat_format.format_windows(df, budget=200, history=2).collect()
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for c in {r[0] for r in rows}:
        said = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=order)]
        own = sorted((w for w in windows if w.conv_id == c), key=lambda w: w.window)
        got, loss = [], []
        for w in own:
            turns = read(w.formatted)
            got += turns[w.n_repeated :]
            loss += [w.formatted[s.start : s.start + s.length] for s in w.loss_spans]
            if said[0][0] == "system":
                assert turns[0] == said[0]
            fresh = [len(t.encode()) for _, t in turns[w.n_repeated :]]
            if len(fresh) > 1 and len(said[0][1]) < 300:
                assert sum(-(-n // 4) + 4 for n in fresh) <= 204 and sum(n + 15 for n in fresh) <= 200
            assert w.n_repeated <= 3
        assert got == said
        assert loss == [t.replace("\\", "\\b").replace("<", "\\l").replace(">", "\\g") for r, t in said if r == "assistant"]
    d = {r.conv_id: r for r in chat_format.digest(chat_format.format_windows(df, budget=200)).collect()}
    assert d[50].n_turns == 2 and d[50].loss_chars == 8 and d[50].loss_sha256 == hashlib.sha256(b"samesame").hexdigest()
    assert chat_format.format_windows(df.limit(0)).count() == 0


def test_windows_keep_the_budget_in_real_tokens(spark):
    """Of every window that is not marked, the ids are at most the budget; a marked one holds a turn that can't be less, or a system turn."""
    encode = packing.encoder()
    rng = random.Random(14)
    made = [(c, t, rng.choice(["user", "assistant"]) if t else "system", "".join(rng.choice(["word ", "漢", "é", "<", "\\", "\n", "12"]) for _ in range(rng.choice([3, 40, 200, 900] if c % 4 == 0 else [3, 20, 50])))) for c in range(30) for t in range(rng.randrange(1, 40))]
    turns = spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame([(10_000 + c, t, r, x) for c, t, r, x in made], turns.schema))
    windows = chat_format.format_windows(turns).collect()
    assert any(w.over_budget for w in windows) and len({w.conv_id for w in windows}) == turns.select("conv_id").distinct().count()
    for w in windows:
        assert w.over_budget == (len(w.formatted.encode()) > chat_format.BUDGET)
        assert w.over_budget or len(encode(w.formatted)) <= chat_format.BUDGET
        if w.over_budget:
            own = read(w.formatted)
            assert len(own) <= 4 and len(own) - w.n_repeated <= 1 + (own[0][0] == "system")
    counted = turns.withColumn("n", F.lit(300))
    assert all(w.over_budget == (w.formatted.count("</turn>") > 3) and w.formatted.count("</turn>") <= 3 for w in chat_format.format_windows(counted, tokens="n").collect())


def test_chat_runs_no_python(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id bigint, turn bigint, role string, text string")
    assert not re.search("Python|Pandas|Arrow", chat_format.digest(chat_format.format_windows(df))._jdf.queryExecution().executedPlan().toString())


# 7. SimHash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(odd):
    for t in [None, "", "one", "a b c d", "A b C d É É f g h a b c d", LONG]:
        assert simhash.fingerprint(None if t is None else t.encode()) % (1 << 64) == brute_fingerprint(t)
    assert simhash.fingerprints(odd).count() == 8


def test_pigeonring_loses_no_pair():
    rng = np.random.default_rng(4)
    for _ in range(4000):
        x = 0
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            x |= 1 << int(b)
        assert any(simhash.pigeonring(np.array([x], np.uint64), s)[0] for s in range(16))


@pytest.mark.parametrize("block, bits", [(4096, 20), (8, 20), (4096, 24), (4096, 32)])
def test_components_against_brute_force(spark, block, bits):
    rng = random.Random(6)
    fps = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(rng.randrange(8)):
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                base ^= 1 << b
            fps.add(base)
    fps = sorted(fps)
    label = {f: f for f in fps}

    def find(f):
        while label[f] != f:
            f = label[f]
        return f

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 4:
                label[find(a)] = find(b)
    signed = {f: int(np.uint64(f).astype(np.int64)) for f in fps}
    got = {r.node: r.root for r in simhash.components(simhash.links(spark.createDataFrame([(x,) for x in signed.values()], "fp bigint"), block, bits)).collect()}
    pairs = {(find(f), got.get(signed[f], signed[f])) for f in fps}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_near_duplicates(spark, odd, empty):
    got = simhash.group_near_duplicates(odd)
    assert got.count() == 8 and {r.component_id for r in got.where("doc_id in (1, 2, 6)").collect()} == {1}
    assert simhash.group_near_duplicates(empty).count() == 0
    kept = simhash.keep_one_of_each_group(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "5", "None"]
    assert simhash.keep_one_of_each_group(empty).count() == 0


def test_hot_keys_and_crowded_buckets(spark):
    """A dense cloud of fingerprints, one fingerprint of most rows, and a hub: the same components with every limit at its least."""
    rng = random.Random(15)
    centre = rng.getrandbits(64)
    cloud = {centre} | {centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 5, 9]))) for _ in range(160)} | {rng.getrandbits(64) for _ in range(40)}
    signed = [x - (1 << 64) if x >> 63 else x for x in cloud]
    distinct = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    plain = simhash.links(distinct)
    hard = simhash.links(distinct, block=5, task_rows=0, hot=3)
    want = brute_components({x: x % (1 << 64) for x in signed})
    for edges, limits in ((plain, {}), (hard, {"task_rows": 0, "hot": 3})):
        got = {r.node: r.root for r in simhash.components(edges, **limits).collect()}
        assert {x: got.get(x, x) for x in signed} == want
    chain = spark.createDataFrame([(k, k + 1) for k in range(60)], "u bigint, v bigint")
    with pytest.raises(RuntimeError, match="not stable"):
        simhash.components(chain, rounds=1)
    rows = [(k, "one text for most of the rows here") for k in range(50)] + [(100 + k, f"{prose(rng, 9)}") for k in range(6)] + [(200, None), (201, "")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    a, b = ({(r.doc_id, r.fingerprint, r.component_id) for r in simhash.group_near_duplicates(d, **x).collect()} for x in ({}, {"task_rows": 0, "hot": 2}))
    assert a == b and len(a) == len(rows) and {c for i, _, c in a if i < 50} == {0} and {c for i, _, c in a if i >= 200} == {200}


def brute_components(prints):
    """The smallest name that each can reach by links of 4 bits or fewer."""
    out = {}
    for x in sorted(prints):
        if x not in out:
            out[x], todo = x, [x]
            while todo:
                p = prints[todo.pop()]
                near = [y for y in prints if y not in out and (p ^ prints[y]).bit_count() <= 4]
                out.update(dict.fromkeys(near, x))
                todo += near
    return out


# 8. and 10. classifiers


def test_quality_ranking(spark, odd, empty):
    rng = random.Random(8)
    good = lambda: " ".join(rng.choice(["stone", "river", "walk", "green"]) for _ in range(50)) + "."
    rows = [(i, good() if i % 3 else " ".join(w + "$$$" for w in good().split())) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(150)] + [(0, 0), (None, 1), (7, None)], "doc_id bigint, quality int")
    d = docs(spark, *rows)
    ranker = quality_classifier.train(d, labels, quality_classifier.remainder(F.col("doc_id"), 5) != 0)
    got = {r.doc_id: r.score for r in quality_classifier.score_documents(d, ranker).collect()}
    assert all((got[i] >= 0.3) == (i % 3 > 0) for i in range(200)) and all(0 <= s <= 1 for s in got.values())
    assert quality_classifier.score_documents(odd, ranker).count() == 8 and quality_classifier.score_documents(empty, ranker).count() == 0
    none = quality_classifier.train(d, labels.limit(0), F.lit(True))
    assert quality_classifier.score_documents(odd, none).where("score between 0 and 1").count() == 8
    kept = quality_classifier.filter_quality(d, labels, F.lit(True))
    assert kept.columns == d.columns and kept.count() == sum(i % 3 > 0 for i in range(200))


def brute_ranker(stats, label, ridge=1e-3):
    """Mean, scale, weights and threshold from all pairs, one by one."""
    x = quality_classifier.features(stats)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.clip((x - mean) / scale, -6, 6)
    d = (z[label == 1][:, None] - z[label == 0][None]).reshape(-1, z.shape[1])
    w, step = np.zeros(z.shape[1]), np.ones(1)
    while np.abs(step).max() > 1e-9:
        p = 1 / (1 + np.exp(d @ w))
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge * np.eye(len(w)), ridge * w - (d * p[:, None]).mean(0))
        w = w - step
    return mean, scale, w, np.quantile(z @ w, (label == 0).mean())


def test_ranker_learns_from_all_pairs(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["stone", "River", "go!", "a$", "77", "a$ a$", "on\non"]) for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    label = np.array([int(rng.random() < (0.2 if t.count("$") * 4 > len(t.split()) else 0.8)) for t in texts])
    d = docs(spark, *enumerate(texts))
    labels = spark.createDataFrame([(i, int(y)) for i, y in enumerate(label)], "doc_id bigint, quality int")
    got = quality_classifier.train(d, labels, F.lit(True))
    mean, scale, weights, threshold = brute_ranker(np.array([text_stats(t.encode()) for t in texts]), label)
    assert np.allclose(got.mean, mean, atol=1e-8) and np.allclose(got.scale, scale, atol=1e-8)
    assert np.allclose(got.weights, weights, atol=2e-4) and abs(got.threshold - threshold) < 2e-3


def test_ranker_learns_from_every_labelled_row(spark):
    d = spark.range(13_000).select(F.col("id").alias("doc_id"), F.expr("concat(repeat('word ', cast(id % 7 as int)), repeat('$ ', cast(id % 5 as int)))").alias("text"))
    labels = d.select("doc_id", F.expr("cast(doc_id % 5 < 2 or doc_id % 11 = 0 as int)").alias("quality"))
    ranker = quality_classifier.train(d, labels, F.lit(True))
    stats = np.array([text_stats(r.text.encode()) for r in d.orderBy("doc_id").collect()])
    label = np.array([r.quality for r in labels.orderBy("doc_id").collect()])
    assert np.allclose(ranker.mean, quality_classifier.features(stats).mean(0), atol=1e-8)
    assert abs(ranker.threshold - np.quantile(ranker.raw(stats), (label == 0).mean())) < 1e-8


def test_training_rows_with_and_without_broadcast(spark):
    d = docs(spark, (1, "a b"), (1, "a"), (2, None), (3, "not labelled"), (None, "x"), (4, "c $"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (4, 0), (4, None), (9, 1), (None, 1)], "doc_id bigint, quality int")
    want = sorted([(1, *text_stats(b"a")), (0, *text_stats(None)), (0, *text_stats(b"c $"))])
    for n in (4, 3):
        assert sorted(map(tuple, quality_classifier.training_rows(d, labels, F.lit(True), broadcast_rows=n).collect())) == want


def test_toxicity(spark, odd, empty):
    rng = random.Random(12)
    word = lambda: rng.choice("stone river walk green under seven later often house".split()) + rng.choice(["", "s", "ly", "ed", "ing"])
    rows = []
    for i in range(300):
        w = [word() for _ in range(60)]
        if i % 4 == 0:
            for _ in range(3):
                w[rng.randrange(60)] = rng.choice(["blurgh", "snarfle", "grotzky"]) + rng.choice(["", "s", "er"])
        rows.append((i, " ".join(w)))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id bigint, toxic int")
    model = toxicity.train(docs(spark, *rows), labels, F.lit(True))
    got = {r.doc_id: r.score for r in toxicity.score_documents(docs(spark, *rows), model).collect()}
    assert all((got[i] >= 0.3) == (i % 4 == 0) for i in range(200, 300))
    assert toxicity.score_documents(odd, model).where("score between 0 and 1").count() == 8
    assert toxicity.score_documents(empty, model).count() == 0
    blank = toxicity.train(empty, labels, F.lit(True))
    assert toxicity.score_documents(odd, blank).count() == 8


# 9. pages


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("just text &amp; more", "just text & more"),
        ("<html><body><nav><a href='/'>Home</a></nav><article><h1>T</h1><p>One,  two</p><p>Th<b>re</b>e<br>four</article><footer>f</footer>", "T One, two Three four"),
        ("<body><header><h1>Site</h1></header><div class='main'><p>A long, long, paragraph of words.</p><p>Next.</p></div><div class='sidebar'><p>x, y, z</p></div><script>var t='</p>'</script></body>", "A long, long, paragraph of words. Next."),
        ("<article><p>Body, text.</p><aside>no</aside><form>no<input></form><div id=comments><p>I, too, think</p></div><!-- <p>no</p> --><p>End&nbsp;&eacute;</p></article>", "Body, text. End é"),
        ("<div><ul class='menu'><li><a href=/>m</a></ul><p><b>Open bold<br><p>second</div><style>p{}</style>", "Open bold second"),
        ("<p>a < b and c > d</p>", "a < b and c > d"),
        ("<div class='site-header'><h1>Site</h1></div><main><header><h1>T</h1></header><p>Body, of text.</p><ol class='commentlist'><li>I, think, so</ol></main>", "T Body, of text."),
        ("<div id=header>Top</div><div class='post has-sidebar'><div class='entry-header'><h1>T</h1></div><p>One, two, three.</p><p>Four.</p></div><div class='adsense'>buy</div>", "T One, two, three. Four."),
        ("<article><p title='a>b'>quoted</p><div class=\"share\">tweet</div></article><div role=dialog>cookies</div>", "quoted"),
    ],
)
def test_extraction(page, text):
    assert html_extract.extract(page) == text


def test_extraction_rows(spark):
    pages = spark.createDataFrame([(1, "<p>x</p>", "old"), (1, "<p>x</p>", "old"), (2, None, None)], "page_id bigint, html string, text string")
    got = html_extract.extract_pages(pages)
    assert sorted((r.page_id, r.text) for r in got.collect()) == [(1, "x"), (1, "x"), (2, "")]
    assert html_extract.extract_pages(pages.limit(0)).count() == 0
    assert html_extract.extract("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


ARTICLE = "A long enough sentence, with commas, for the article here. " * 5


@pytest.mark.parametrize(
    "page",
    [
        '<a "x' * 20_000, "<a" * 50_000, "<a b" * 20_000, "<div>" * 8000 + "</p>" * 8000, '<a b=">" ' * 20_000, "<script>" + "</script" * 50_000, "<svg>" * 50_000, "<ul>" + "<b>" * 4000 + "<li></li>" * 4000, "<p><table>" + "<b>" * 4000 + "<div></div>" * 4000,
        "<li><ul>" + "<b>" * 4000 + "<li></li>" * 4000, "<!" * 50_000, "<a b='x>" * 20_000 + '"', "<a<" * 50_000 + ">", "<!--" * 50_000, "<b>" * 8000 + "<p></b>" * 8000, '<a b="' * 20_000 + ">" * 20_000, "<header>" * 8000, "<tr>" * 8000 + "<td>" * 8000, "&" * 200_000, "<p>" * 50_000,
    ],
)
def test_broken_pages_take_no_time(page):
    began = time.process_time()
    html_extract.extract(page)
    assert time.process_time() - began < 1


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<html><head><title>t</title><body><p>{ARTICLE}</p></body>", ARTICLE), (f"<head><title>t</title><p>{ARTICLE}</p>", ARTICLE), (f"<head><title>t</title></head><p>{ARTICLE}", ARTICLE),
        (f"<body><form action=x><nav>menu</nav><div><p>{ARTICLE}</p><p>{ARTICLE}</p></div></form>", ARTICLE * 2), (f"<body><form><p>{ARTICLE}</p></form><article><p>Two.</p></article>", "Two."), (f"<div class=sidebar>{ARTICLE * 3}</div><article><p>{ARTICLE}</p></article>", ARTICLE),
        (f"<article><h2 id='related-work'>Related work</h2><p>{ARTICLE}</p><h2 id='social-history'>Then</h2><p class='notice'>See.</p><div class='market-share'><p>It grew.</p></div></article>", f"Related work {ARTICLE} Then See. It grew."),
        (f"<article><p>{ARTICLE}</p><div class='share-buttons'>Tweet</div><p class='ad'>Buy</p><div class='article-comments'><p>{ARTICLE}</p></div><footer>f</footer></article>", ARTICLE), (f'<article><p title="a > b">{ARTICLE}</p><p title="open>x</p></article>', ARTICLE + "x"),
        (f"<article><p>{ARTICLE}<b>bold</p><p>next</b> more</p></article>", f"{ARTICLE}bold next more"), (f"<article><p>a &amp; b&nbsp;c {ARTICLE}</p><svg><p>{ARTICLE}</p></article>", f"a & b c {ARTICLE}{ARTICLE}"), ("<p class='notice'>only this</p>", "only this"), ("<p>x < y and a <= b</p>", "x < y and a <= b"),
    ],
)
def test_articles_stay_whole(page, want):
    assert html_extract.extract(page) == " ".join(want.split())


def test_pages_against_another_parser(spark):
    """The articles of the generated pages, read by the standard library's parser: all their words and no others, in order."""
    from html.parser import HTMLParser

    class Article(HTMLParser):
        def __init__(self):
            super().__init__()
            self.depth, self.out = 0, []

        def handle_starttag(self, tag, attrs):
            self.depth += tag == "article"
            self.out += [" "] * (self.depth > 0 and tag not in ("b", "a", "i"))

        def handle_endtag(self, tag):
            self.depth -= tag == "article"

        def handle_data(self, data):
            self.out += [data] * (self.depth > 0)

    for row in spark.read.parquet(f"{DATA}/pages.parquet").collect():
        parser = Article()
        parser.feed(row.html)
        assert html_extract.extract(row.html) == " ".join("".join(parser.out).split())


# passages


def prose(rng, n):
    return " ".join("".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(n))


def test_passages_stay_in_one_document_and_no_document_is_exempt(spark):
    rng = random.Random(21)
    passage = prose(rng, 60)
    rows = [(i, f"{prose(rng, 5)}\n{passage}") for i in range(6)] + [(9, f"{prose(rng, 40)}\n{passage}")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_passages(docs(spark, *rows)).collect()}
    assert sum(passage in t for t in got.values()) == 1 and all(t.split("\n")[0] == got[i].split("\n")[0] for i, t in rows)


def test_a_passage_of_a_text_with_copies_stays_in_one_row(spark):
    rng = random.Random(22)
    passage, alone = prose(rng, 50), prose(rng, 40)
    copied = f"{passage}\n{prose(rng, 30)}"
    rows = [(i, copied) for i in range(6)] + [(10 + i, f"{prose(rng, 30)}\n{passage}") for i in range(3)] + [(20, alone), (21, alone)]
    got = {r.doc_id: r for r in line_dedup.dedup_passages(docs(spark, *rows)).collect()}
    assert len(got) == len(rows) and sum(passage in r.text for r in got.values()) == 1 == sum(alone in r.text for r in got.values())
    assert got[20].n_dropped + got[21].n_dropped == 1


def test_a_passage_within_other_lines_goes_to_its_last_word(spark):
    rng = random.Random(23)
    mixed = f"{prose(rng, 14)}. {prose(rng, 4)}. {prose(rng, 3)}! {prose(rng, 20)}. {prose(rng, 5)}"
    shared = [prose(rng, 54), mixed, prose(rng, 9) + " end.", prose(rng, 40)]
    rows = []
    for k, p in enumerate(shared[:3]):
        dot = "." if k == 2 else ""
        rows += [(10 * k + i, f"{prose(rng, 30)}{dot} {p} {prose(rng, 30)}") for i in range(3)]
    rows += [(90, f"{prose(rng, 20)}\n{shared[3]}\n{prose(rng, 5)}"), (91, f"{prose(rng, 20)} {shared[3]} {prose(rng, 20)}")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_passages(docs(spark, *rows)).collect()}
    for k, p in enumerate(shared):
        own = {i: t for i, t in rows if i // 10 == (k if k < 3 else 9)}
        left = [i for i in own if p in got[i]]
        assert len(left) == 1
        for i, t in own.items():
            assert i in left or got[i].split() == t.replace(p, "").split(), (k, i)


def test_a_passage_in_short_lines_goes(spark):
    rng = random.Random(24)
    passage = "\n".join(prose(rng, n) for n in (5, 2, 7, 1, 4, 9, 3, 6, 8, 5, 2))
    rows = [(i, f"{prose(rng, 20)}\n{passage}\n{prose(rng, 20)}") for i in range(2)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_passages(docs(spark, *rows)).collect()}
    assert sorted(passage in got[i] for i, _ in rows) == [False, True]
    assert all(got[i] in (t, t.replace(passage + "\n", "")) for i, t in rows)


def test_a_passage_wrapped_in_other_ways_goes_whole(spark):
    rng = random.Random(25)
    w = prose(rng, 90).split()
    wrap = lambda k: "\n".join(" ".join(w[i : i + k]) for i in range(0, 90, k))
    rows = [(k, f"{prose(rng, 15)} {wrap(k)} {prose(rng, 15)}") for k in (5, 7, 90)] + [(1, f"{prose(rng, 15)} {' '.join(w[:45])} {prose(rng, 15)}")]
    got = {r.doc_id: r.text.split() for r in line_dedup.dedup_passages(docs(spark, *rows)).collect()}
    assert sum(x in w for t in got.values() for x in t) == 90
    assert all([x for x in t.split() if x not in w] == [x for x in got[i] if x not in w] for i, t in rows)


def test_release_waits_until_the_jvm_knows_what_python_let_go(spark):
    """py4j's thread, once idle, looks for work a second later; collections before that free nothing."""
    jvm, waiting = spark.sparkContext._jvm, spark.sparkContext._gateway._gateway_client.finalizer_deque
    for _ in range(3):
        thing = jvm.java.lang.Object()
        ref = jvm.java.lang.ref.WeakReference(thing)
        jvm.java.lang.Object()
        while waiting:
            time.sleep(0.001)
        del thing
        release(spark)
        assert ref.get() is None


def test_short_notices_in_long_blocks_and_repeated_ones():
    known = license_scan.TEMPLATES
    names = lambda text: sorted(x[2] for x in license_scan.Scanner(known).scan(text))
    assert names(f"Copyright (c) 2020 A. All rights reserved.\n{known['bsd-3-clause']}") == ["all-rights-reserved", "bsd-3-clause"]
    assert names(f"{known['bsd-3-clause']}\n{known['mit-line']}") == ["bsd-3-clause", "mit-line"]
    filler = " ".join(f"{chr(97 + k % 26)}{chr(97 + k * 7 % 26)}word" for k in range(100))
    for name in ("mit-line", "bsd-line", "cc-by-line", "apache-2.0-line"):
        assert names(f"{filler} {known[name]}") == [name]
    assert names(f"{known['mit-line']} And so on. {known['mit-line']}\n{known['isc']}\n{known['isc']}") == ["isc", "isc", "mit-line", "mit-line"]
