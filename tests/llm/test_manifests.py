"""Merkle manifest, conversation repair and WARC archives against brute force, with odd rows and empty tables."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from guidewave.functions.session import cut_lineage, shared_path
from guidewave.llm import conversations, merkle, queries, warc
from guidewave.llm.numbering import numbered

SF = "/root/testdata/sf0.001"
CLASHES = "number group digest block key symbol size shard part head run upto weight all kind leaf root".split()


def clashing(frame):
    return frame.withColumns({c: F.lit(f"clash {c}") for c in CLASHES})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# places

@pytest.mark.parametrize("parts", [1, 3, 16])
def test_numbers_and_sums_are_exact_at_any_partitioning(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice(["a", "a", "a", "b", ""]), rng.choice([None, 1, 2, 2, 2, 3]), k % 5) for k in range(400)]
    table = cut_lineage(spark.createDataFrame(rows, "g string, v int, w long").repartition(parts))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts * 3))
    try:
        found = numbered(table, "g", [F.col("v").asc_nulls_first()], "w").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    before = 0
    for r in sorted(found, key=lambda r: (r["g"], r["number"])):
        assert r["before"] == before
        before += r["w"]
    for g in ("a", "b", ""):
        own = sorted((r for r in found if r["g"] == g), key=lambda r: r["number"])
        assert [r["number"] for r in own] == list(range(len(own)))
        values = [(r["v"] is not None, r["v"]) for r in own]
        assert values == sorted(values)


# Merkle manifest

def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute_leaf(row, more=0):
    n = None if row[3] is None else row[3] + more
    return sha("".join(map(written, (row[0], row[1], row[2], n, row[4]))))


def brute_tree(nodes):
    """Root and, per leaf, the (sibling or '', node is right) pairs, one whole level after another."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(place):
            paths[k].append((nodes[p ^ 1] if p ^ 1 < len(nodes) else "", p % 2))
        place = [p // 2 for p in place]
        nodes = [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def brute_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(r)))
        trees[lang] = brute_tree([brute_leaf(r) for r in groups[lang]])
    root, above = brute_tree([trees[lang][0] for lang in langs])
    found = []
    for k, lang in enumerate(langs):
        for row, path in zip(groups[lang], trees[lang][1], strict=True):
            found.append((row[0], brute_leaf(row), trees[lang][0], root, "".join(s for s, _ in path + above[k]), path + above[k]))
    return found


ODD = [(1, "s", "en", 3, "one"), (2, None, None, None, None), (3, "s", "en", 0, ""), (3, "s", "en", 0, ""), (3, "t", "en", 7, "other"), (None, "s", "en", 1, "x"), (None, "s", "zz", 1, "x"),
       (9, "s", "ß", 5, "é\U0001f600" * 3), (10, "s", "", 5, "long " * 60_000), *[(k, "s", "fr", k, f"text {k}") for k in range(20, 57)]]
FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("bits", [1, 2, 4, 10])
def test_manifest_equals_level_by_level_trees(spark, bits):
    docs = clashing(spark.createDataFrame(ODD, FIELDS))
    found = merkle.manifest(docs, bits=bits).withColumn("folded", merkle.folded(F.col("leaf"), F.col("witness"))).collect()
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], "".join(s["digest"] for s in r["witness"])) for r in found]
    order = lambda rows: sorted(rows, key=repr)
    assert order(got) == order(r[:5] for r in brute_manifest(ODD))
    assert all(r["folded"] == r["root"] for r in found)


def test_appending_gives_the_manifest_of_the_whole(spark):
    first, second = [r for r in ODD if r[0] is not None and r[0] < 30], [r for r in ODD if r[0] is not None and r[0] >= 30]
    frame = lambda rows: spark.createDataFrame(rows, FIELDS)
    begun = cut_lineage(merkle.manifest(frame(first), bits=2))
    grown = merkle.manifest(frame(second), bits=2, earlier=begun)
    whole = merkle.manifest(frame(first + second), bits=2)
    assert sorted(map(tuple, grown.select("doc_id", "leaf", "root", "number").collect())) == sorted(map(tuple, whole.select("doc_id", "leaf", "root", "number").collect()))
    with pytest.raises(ValueError, match="above"):
        merkle.manifest(frame(first), bits=2, earlier=begun)


def test_tampering_breaks_exactly_the_changed_leaves(spark):
    docs = spark.createDataFrame(ODD, FIELDS)
    found = merkle.manifest(docs, docs["n_chars"] + F.when(docs["doc_id"] % 2 == 0, 1).otherwise(0), bits=2)
    for r in found.withColumn("ok", merkle.folded(F.col("claimed"), F.col("witness")) == F.col("root")).collect():
        assert r["ok"] == (r["doc_id"] is None or r["doc_id"] == 2 or r["doc_id"] % 2 == 1)


def test_registered_manifest(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    own = {r[0]: r for r in rows}
    expected = {}
    for doc_id, leaf, subroot, root, siblings, path in brute_manifest(rows):
        node = brute_leaf(own[doc_id], int(zlib.crc32(str(doc_id).encode()) % 7 == 0))
        for sibling, right in path:
            node = sha(sibling + node if right else node + sibling)
        expected[doc_id] = (leaf, subroot, root, sha(siblings), node, node == root)
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in queries.QUERIES["op11_merkle_manifest"](spark, SF).collect()} == expected


def test_manifest_of_no_documents(spark):
    assert merkle.manifest(spark.createDataFrame([], FIELDS)).count() == 0


# conversation repair

def brute_faults(rows):
    """rows: (role, text) in order -> (role initial, fault)."""
    seen, found = set(), []
    for role, text in rows:
        kept = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not kept else "duplicate" if (role, text) in seen else "none" if kept[-1] in ".!?" else "truncated"
        seen.add((role, text))
        found.append((role[:1], fault))
    return found


def brute_repair(rows):
    """Every edit sequence with up to two inserts at each place, by plain recursion over prefixes."""
    marks = brute_faults(rows)
    best = {("", ""): 0}  # (last role initial, + where rows stand before it, audit) -> cost

    def put(table, initials, audit, cost):
        key = (initials, audit)
        if cost < table.get(key, 1e9):
            table[key] = cost

    def step(initials, letter):
        last = initials[0] if initials else ""
        if letter == "s":
            return "s" if initials == "" else None
        if letter == "u":
            return "u+" if last in ("", "s", "a") else None
        return "a+" if last == "u" else None

    def inserted(table):
        for _ in range(2):
            for (initials, audit), cost in list(table.items()):
                for letter in "ua":
                    now = step(initials, letter)
                    if now:
                        put(table, now, audit + "I", cost + 5)
        return table

    def pruned(table):
        # equal states: only the cheapest, then least, audits can win, as the rest of the edits is the same for all
        found = {}
        for (initials, audit), cost in table.items():
            state = initials[:1]
            if state not in found or (cost, audit) < found[state][0]:
                found[state] = ((cost, audit), initials)
        return {(initials, best[1]): best[0] for best, initials in found.values()}

    exhaustive = len(rows) <= 4
    for initial, fault in marks:
        nxt = {}
        for (initials, audit), cost in inserted(dict(best)).items():
            put(nxt, initials, audit + "D", cost + 2)
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            if initial in ("s", "u", "a") and step(initials, initial):
                put(nxt, step(initials, initial), audit + "K", cost + extra)
            for letter in "ua":
                if step(initials, letter):
                    put(nxt, step(initials, letter), audit + "R", cost + 1 + extra)
        best = nxt if exhaustive else pruned(nxt)
    cost, audit = min((cost, audit) for (initials, audit), cost in inserted(dict(best)).items() if initials[:1] in ("", "a"))
    lines, at, last = [], 0, ""
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        if letter == "K":
            role, text = rows[at]
        else:
            role, text = ("assistant" if last == "u" else "user"), ("" if letter == "I" else rows[at][1])
        at += letter != "I"
        last = role[:1]
        lines.append(f"{role}:{text}")
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(marks))
    count = lambda fault: sum(m[1] == fault for m in marks)
    return count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, "\n".join(lines)


def random_rows(rng, n):
    roles = ["system", "user", "assistant", "tool", "user", "assistant", "", " "]
    texts = ["One.", "Two!", "three", "", " \t", "Four? ", "five. six", " "]
    return [(rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"{rng.random()}.") for _ in range(n)]


def symbols(rows):
    return "".join(conversations.symbol(r if r and r in "sua" else "x", fault) for r, fault in brute_faults(rows))


def test_short_sequences_equal_the_enumeration_of_all_edits():
    rng = random.Random(1)
    for n in [0, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4] * 12:
        rows = random_rows(rng, n)
        counts, cost, audit = conversations.repair(iter([symbols(rows)]), ())
        assert (*counts[:4], cost, audit) == brute_repair(rows)[:6]


def test_rules_and_pieces_change_nothing():
    rng = random.Random(2)
    for n in (5, 40, 300):
        piece = symbols(random_rows(rng, n))
        rules = tuple(conversations.independent([piece[i : i + 2] for i in range(0, n - 1, 3)]))
        plain = conversations.repair(iter([piece]), ())
        assert conversations.repair(iter([piece]), rules) == plain
        assert conversations.repair(iter([piece[:7], piece[7:30], piece[30:]]), rules) == plain
        assert plain[1:] == brute_repair(rows_of(piece))[4:6]


def rows_of(piece):
    """Rows with the faults of ``piece``."""
    found = []
    for k, s in enumerate(piece):
        role, fault = divmod(ord(s) - conversations.FIRST, 4)
        found.append((["system", "user", "assistant", "tool"][role], {"none": f"{k}.", "blank": "", "truncated": f"{k}"}.get(conversations.FAULTS[fault], "")))
    return found


def test_ropes_compare_as_texts():
    rng = random.Random(3)
    ropes = [(1, c) for c in "DIKR"] + [conversations.EMPTY]
    for _ in range(300):
        ropes.append(conversations.joined(rng.choice(ropes), rng.choice(ropes[-20:])))
    for a, b in itertools.product(ropes[::5], ropes[::7]):
        assert conversations.precedes(a, b) == (conversations.flat(a) < conversations.flat(b))


def test_pairs_of_a_round_never_overlap():
    assert conversations.independent(["ab", "bc", "cd", "aa", "ee", "eb", "xd"]) == ["ab", "cd", "ee", "xd"]


def repaired(spark, rows):
    frame = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = cut_lineage(conversations.repairs(frame))
    edited = conversations.repaired_rows(frame, found.select("key", "audit")).orderBy("key", "place").collect()
    digests = {r["key"]: r["repaired_sha256"] for r in conversations.repaired_digests(frame, found.select("key", "audit")).collect()}
    lines = {}
    for r in edited:
        lines.setdefault(r["key"], []).append(f"{r['role']}:{r['text']}")
    assert digests == {r["key"]: sha("\n".join(lines.get(r["key"], []))) for r in found.collect()}
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], "\n".join(lines.get(r["key"], []))) for r in found.collect()}


def brute_table(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    found = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha(r[2])))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        found[conv] = (gaps, *brute_repair([r[1:] for r in own]))
    return found


def test_repairs_of_odd_conversations(spark):
    rng = random.Random(4)
    rows = [(k, t, *row) for k in range(60) for t, row in enumerate(random_rows(rng, k % 9 + 1))]
    rows += [(None, 1, "user", "Hi."), (None, None, None, None), (100, None, "user", "A."), (100, None, "assistant", "B."), (101, 5, "user", "Same."), (101, 5, "user", "Same."), (101, 5, "assistant", "C."), (101, 9, "user", "C.")]
    rows += [(102, 1, "user", "w " * 200_000 + "."), (102, 2, "assistant", "x" * 300_000)]
    assert repaired(spark, rows) == brute_table(rows)


def test_one_long_conversation_is_cut_into_pieces(spark):
    rng = random.Random(5)
    rows = [(7, t, *row) for t, row in enumerate(random_rows(rng, 3 * conversations.PIECE_ROWS + 17))]
    assert repaired(spark, rows) == brute_table(rows)


def test_repairs_of_no_conversations(spark):
    assert repaired(spark, []) == {}


def test_registered_repair(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows = []
    for conv, turn, role, text in table:
        k = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if k == 1 else "".join(c for c in text if c not in ".!?") if k == 2 else text
        rows += [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    expected = {conv: (0, 0, 0, 0, 0, 0, "", sha("")) for conv, *_ in table} | {k: (*v[:7], sha(v[7])) for k, v in brute_table(rows).items()}
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r["conv_id"]: tuple(r[n] for n in names) for r in queries.QUERIES["op12_conversation_repair"](spark, SF).collect()} == expected


# WARC

PAGES = "page_id long, url string, html string"
BODY = "<p>" + "same payload " * 20 + "</p>"


def pages():
    rows = [(k, f"http://h/{k}", f"<html>{k} " + "é" * (k * 7 % 90) + "</html>") for k in range(60)]
    rows += [(k, f"http://dup/{k}", BODY) for k in range(100, 140)] + [(None, None, None), (None, "http://none", BODY), (200, "a b\r\nc: dé", ""), (201, "", "x" * 99), (202, "", "x" * 99), (203, "", "x" * 100), (204, "", "x" * 100)]
    rows += [(205, "http://twice", BODY + "!")] * 3 + [(206, "http://long", "long text " * 90_000), (207, "http://nul", "a\x00b\r\n\r\nWARC/1.1\r\n" * 9)]
    return rows


def brute_archive(rows):
    first = {}
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(html or "", page)
    found, used = [], set()
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        html = html or ""
        size = len(html.encode())
        revisit = size >= 100 and html in used
        used.add(html)
        found.append((page, size, sha(html), "revisit" if revisit else "response", first[html] if revisit else None))
    return sorted(found, key=repr)


def archive(spark, rows, parts=3, **limits):
    path = shared_path(spark, "warc")
    listed = warc.write_archive(clashing(spark.createDataFrame(rows, PAGES).repartition(parts)), path, **limits).orderBy("file").collect()
    return path, listed


@pytest.mark.parametrize("limits", [{}, {"shard_bytes": 5_000, "file_bytes": 900}, {"shard_bytes": 30_000, "file_bytes": 1}])
def test_archives_round_trip(spark, limits):
    path, listed = archive(spark, pages(), **limits)
    read = warc.read_archive(spark, path)
    records = read.collect()
    number = lambda v: None if v is None else int(v)
    assert sorted(((number(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], number(r["refers_page"])) for r in records), key=repr) == brute_archive(pages())
    whole = {r["record_id"]: r["payload"] for r in records if r["record_type"] == "response"}
    kept = sorted(whole.get(r["refers_to"] or r["record_id"]) for r in records)
    assert kept == sorted(html or "" for _, _, html in pages())
    assert len({r["record_id"] for r in records}) == len(records) == sum(m["records"] for m in listed)
    assert warc.broken_revisits(read).count() == 0
    if limits.get("file_bytes") == 900:
        assert len(listed) > 20 and all(m["bytes"] <= 900 or m["records"] == 1 for m in listed)


def test_files_do_not_depend_on_partitions(spark):
    limits = {"shard_bytes": 5_000, "file_bytes": 900}
    one, other = archive(spark, pages(), 1, **limits)[1], archive(spark, pages()[::-1], 7, **limits)[1]
    assert one == other


def test_files_hold_what_the_manifest_says_and_nothing_is_left_over(spark):
    path, listed = archive(spark, pages(), shard_bytes=5_000)
    found = {r["path"].rsplit("/", 1)[-1]: hashlib.sha256(r["content"]).hexdigest() for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()}
    assert found == {m["file"]: m["sha256"] for m in listed}
    with pytest.raises(FileExistsError):
        warc.write_archive(spark.createDataFrame(pages(), PAGES), path)


def test_a_changed_byte_fails_the_read():
    record = warc.build_record("response", warc.record_id(0, 5), "http://h", warc.DATE, sha(BODY), len(BODY), BODY.encode(), None)
    assert warc.parse_record(record)[1].decode() == BODY
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(record.replace(b"same", b"sane", 1))
    with pytest.raises(ValueError, match="malformed"):
        warc.parse_record(record[:-5])


def test_broken_revisits_are_told(spark):
    rows = [("a", "response", None, "d1"), ("b", "revisit", "a", "d1"), ("c", "revisit", "a", "d2"), ("d", "revisit", "z", "d1")]
    frame = spark.createDataFrame(rows, "record_id string, record_type string, refers_to string, payload_digest string")
    assert {(r["refers_to"], r["payload_digest"]) for r in warc.broken_revisits(frame).collect()} == {("a", "d2"), ("z", "d1")}


def test_archive_of_no_pages(spark):
    path, listed = archive(spark, [])
    assert listed == [] and warc.read_archive(spark, path).count() == 0
