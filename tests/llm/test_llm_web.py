import base64
import collections
import glob
import gzip
import hashlib
import math
import pathlib
import random
import re

import duckdb
import pytest
from hypothesis import given, settings, strategies as st

from tickspan.llm import html_text as H, url_filter as U, warc as W

PAGES = "page_id long, url string, html string, host string, rule string"


# -- url filter

def brute_filter(rows, rules=U.RULES, margin=U.MARGIN):
    def parse(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest).group()
        return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match("[^?#]*", rest[len(host):]).group()
    out, edges, count = [], collections.Counter(), collections.defaultdict(collections.Counter)
    for i, url, html in rows:
        host, path = parse(url)
        best = None
        for rule, action in rules:
            h, _, p = rule.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                best = max(best or (0, "", ""), (len(rule), rule, action))
        out.append((i, host, path, best))
        if host:
            count[host]["n"] += 1
            count[host][best[2] if best else "none"] += 1
        for href in re.findall(r"""(?i)<a\s[^>]*?href\s*=\s*["']?((?:https?:)?//[^"'\s>]+)""", html or ""):
            to, _ = parse("x:" + re.sub("(?i)^https?:", "", href))
            if host and to and to != host:
                edges[host, to] += 1
    score = {}
    for good in (True, False):
        start = {h: math.floor(U.UNIT * (1 - U.DAMPING)) for h, c in count.items() if 2 * c["allow" if good else "block"] > c["n"]}
        links = [((a, b) if good else (b, a), n) for (a, b), n in edges.items()]
        deg = collections.Counter()
        for (a, _), n in links:
            deg[a] += n
        now, was = dict(start), None
        while now != was:
            was, new = now, collections.Counter(start)
            for (a, b), n in links:
                if a in now:
                    new[b] += math.floor(now[a] * (U.DAMPING * n / deg[a]))
            now = +new
        score[good] = now
    res = []
    for i, host, path, best in out:
        t, d = score[True].get(host, 0), score[False].get(host, 0)
        res.append((i, host, path, best[1] if best else None, best[2] if best else "block" if d > margin * t else "allow", t, d))
    return res


def link(*hosts):
    return "<p>" + "".join(f"<a class=x href='{'https:' if i % 2 else ''}//{h}/x'>l</a>" for i, h in enumerate(hosts)) + '<a href="/in">i</a>'


def test_rules_and_links_against_brute_force(spark):
    rnd = random.Random(6)
    hosts = [f"h{i}.site.com" for i in range(12)] + [f"s{i}.farm.net" for i in range(4)] + ["example.net", "www.example.net", "a.org", "b.a.org",
                                                                                            "example.com", "x.example.com", "net", "evilnet"]
    rows = []
    for i in range(400):
        host = rnd.choice(hosts)
        path = rnd.choice(["", "/", "/en/", "/en", "/de/x", "/fr/a?b#c", "?q=/fr/", "#/de/", "/fr/"])
        rows.append((i, f"{rnd.choice(['http', 'HTTPS', 'x'])}://{host.upper() if i % 3 else host}{path}",
                     link(*rnd.sample(hosts, rnd.randint(0, 3))) if i % 4 else None))
    rows += [(1000, None, link("a.org")), (1001, "no scheme/net/", ""), (1002, "://", None), (1003, "", None), (None, "http://net/x", None),
             (7, rows[7][1], rows[7][2]), (1004, "http://É.net/é?x", "<a href=//" + "n" * 50000 + ".net>")]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)
    got = collections.Counter(tuple(r) for r in U.judged(df).collect())
    assert got == collections.Counter(brute_filter(rows))
    assert {v for *_, v, _, _ in got} == {"allow", "block"}
    by_method = {r[1] for r in got if r[3] is None and r[4] == "block"}
    assert by_method, "distrust reaches hosts without a rule"


def test_oracle_with_links(spark):
    from tickspan.llm import oracle
    rows = [(i, f"http://h{i % 7}.org/{'fr/' if i % 3 else ''}", link(f"h{(i * 3 + 1) % 7}.org", "s.net")) for i in range(40)]
    rows += [(50, "http://s.net/", link("h3.org")), (51, "http://h9.com/", link("s.net")), (52, "http://h10.com/", link("h9.com"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    con = duckdb.connect()
    con.register("pages", df.toPandas())
    rel = con.sql(oracle.URL_FILTER)
    got = collections.Counter(map(tuple, U.judged(df).select(*rel.columns).collect()))
    assert got == collections.Counter(rel.fetchall()) and got == collections.Counter(brute_filter(rows))


def test_hosts_of_very_many_labels_and_chains_end(spark):
    host = "a." * 100_000 + "net"
    df = spark.createDataFrame([(1, f"http://{host}/x", None), (2, "http://" + "b." * 50_000 + "org/fr/", ""), (3, "http://xnet/", "")],
                               "page_id long, url string, html string")
    got = {r.page_id: (r.rule, r.verdict) for r in U.judged(df).collect()}
    assert got == {1: ("net/", "block"), 2: ("org/fr/", "allow"), 3: (None, "allow")}


def test_a_long_chain_carries_no_zero_scores(spark):
    edges = spark.createDataFrame([(f"h{i}", f"h{i + 1}", 1) for i in range(160)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("h160", False)], "host string, trusted boolean")
    got = {r.host: r.distrust for r in U.propagated(seeds, edges).collect()}
    assert min(got.values()) > 0 and 100 < len(got) < 125 and "h159" in got


def test_salted_join_gives_the_same(spark, monkeypatch):
    rows = [(i, f"http://{h}/{'de/' if i % 2 else ''}", link("s.net")) for i, h in enumerate(["example.com", "c.com", "s.net", "d.org"] * 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted(U.judged(df).collect())
    monkeypatch.setattr(U, "BROADCAST_HOSTS", 0)
    assert sorted(U.judged(df).collect()) == want
    assert U.judged(df.limit(0)).collect() == []


def test_scores_are_carried_until_nothing_changes(spark, scratch):
    # h0 -> h1 -> ... -> h15 -> s.net, which is blocked; the last two hosts link in a circle as well
    from tickspan.llm.queries import op3_url_filter
    rows = [(i, f"http://h{i}.site/", link(f"h{i + 1}.site" if i < 15 else "s.net")) for i in range(16)]
    rows += [(20, "http://s.net/", ""), (21, "http://h15.site/", link("h14.site")), (22, "http://alone.site/", "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{scratch}/in/pages.parquet")
    got = {r.page_id: (r.verdict, r.distrust) for r in op3_url_filter(spark, f"{scratch}/in").collect()}

    deg = {f"h{i}": 1 for i in range(1, 16)} | {"s": 1, "h14": 2}      # hosts linking to each
    links = [(f"h{i + 1}", f"h{i}") for i in range(15)] + [("s", "h15"), ("h14", "h15")]
    start = {"s": math.floor(U.UNIT * (1 - U.DAMPING))}
    now, was = start, None
    while now != was:
        new = collections.Counter(start)
        for a, b in links:
            if a in now:
                new[b] += math.floor(now[a] * (U.DAMPING * 1 / deg[a]))
        now, was = dict(new), now
    assert {i: got[i] for i in range(16)} == {i: ("block", now[f"h{i}"]) for i in range(16)}
    assert got[22] == ("allow", 0) and got[0][1] > 0


# -- WARC

def brute_records(rows, least=0):
    ids = collections.defaultdict(list)
    for i, _, h in rows:
        ids[(h or "").encode()].append(i)
    out = collections.Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        top = max((x for x in ids[data] if x is not None), default=None)
        again = len(data) >= least and top is not None and i != top
        out[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response",
            top if again else None] += 1
    return out


ROWS = [(1, "http://a/ b\r\nX: y é", None), (2, None, ""), (3, "http://x", "same"), (4, "u", "same"), (5, "u", "same"), (5, "u", "same"),
        (None, "u", "same"), (None, "z", "alone"), (7, "u", "WARC/1.1\r\n\r\n\x1f\x8b\x08 \x00 é"), (8, "u", "x" * 20_000_000), (9, "", "é\r\n\r\n")]


def page_id(uri):
    return int(uri[12:-1]) if uri and uri[12:-1] != "None" else None


@pytest.mark.parametrize("least", [0, 3, 10])
@pytest.mark.parametrize("few", [True, False])
def test_round_trip(spark, scratch, monkeypatch, least, few):
    if not few:
        monkeypatch.setattr(W, "BROADCAST_PAYLOADS", -1)
    df = spark.createDataFrame([(*r, "k", "s") for r in ROWS], "page_id long, url string, html string, keeper string, sha string")
    W.write(df, f"{scratch}/w", least=least, file_bytes=100_000)
    got = W.read(spark, f"{scratch}/w").collect()
    assert all(r.gap is None for r in got)
    assert collections.Counter((page_id(r.record_id), r.payload_bytes, r.payload_digest, r.type, page_id(r.refers_to_id))
                               for r in got) == brute_records(ROWS, least)
    payload = {page_id(r.record_id): bytes(r.payload) for r in got if r.type == "response"}
    assert payload[7] == ROWS[8][2].encode() and payload[9] == ROWS[10][2].encode()
    for f in glob.glob(f"{scratch}/w/part-*"):      # plain gzip to any other tool
        with open(f, "rb") as g:
            data = g.read()
        assert not data or gzip.decompress(data).startswith(b"WARC/1.1\r\n")


def test_no_pages(spark, scratch):
    W.write(spark.createDataFrame([], "page_id long, url string, html string"), f"{scratch}/w")
    assert W.read(spark, f"{scratch}/w").collect() == []


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_recovers_every_untouched_record(packed):
    rnd = random.Random(packed)
    plain = [W.make_record(i, f"http://h/{i}", b"body %d WARC/1.0\r\n" % i * 40, i // 2 if i % 7 == 0 else None) for i in range(120)]
    parts = [W.member(x) for x in plain] if packed else plain
    starts = [0]
    for p in parts:
        starts.append(starts[-1] + len(p))
    for trial in range(40):
        data, hurt = bytearray(b"".join(parts)), set()
        for _ in range(3):
            k = rnd.randrange(120)
            at = starts[k] + rnd.randrange(len(parts[k]))
            data[at] ^= 0xFF
            hurt.add(k)
        if trial % 4 == 0:
            cut = rnd.randrange(60, 120)
            del data[starts[cut] + len(parts[cut]) // 2:]
            hurt |= set(range(cut, 120))
        if trial % 5 == 0:                       # junk between two records
            k = min(rnd.randrange(60), 59)
            data[starts[k]:starts[k]] = b"\x1f\x8b\x08junk WARC/1.0\r\n\r\n"
            starts_shifted = True
        else:
            starts_shifted = False
        found, at = set(), 0
        for start, end, record, why in W.salvage(bytes(data)):
            assert start == at and (record is None) == (why is not None)
            at = end
            if record and record["record_id"]:
                found.add(page_id(record["record_id"]))
        assert at == len(data)
        assert set(range(120)) - hurt <= found
        assert not starts_shifted or at > 0


@pytest.mark.parametrize("hurt", ["nothing", "record", "crc", "cut", "byte"])
def test_salvage_within_a_member(hurt):
    rnd = random.Random(3)
    plain = [W.make_record(i, f"http://h/{i}", bytes(rnd.choices(range(97, 123), k=3000)), None) for i in range(60)]
    if hurt == "record":                      # one record is wrong inside a member that passes its check
        plain[20] = plain[20][:-600] + b"#" + plain[20][-599:]
    pack = bytearray(gzip.compress(b"".join(plain), mtime=0))
    size = len(pack)
    if hurt == "crc":
        pack[-6] ^= 255
    if hurt == "cut":
        del pack[size // 2:]
    if hurt == "byte":
        pack[size // 2] ^= 255
    after = W.member(W.make_record(99, "u", b"after"))
    rows = list(W.salvage(bytes(pack) + after))
    ids = [page_id(r["record_id"]) for _, _, r, _ in rows if r]
    whole = {"nothing": 60, "record": 60, "crc": 60, "cut": 27, "byte": 27}[hurt]
    assert ids[-1] == 99 and set(ids) >= set(range(whole)) - ({20} if hurt == "record" else set())
    assert len(ids) == len(set(ids)) and (hurt == "record") == (20 not in ids)
    assert any(w for *_, w in rows) == (hurt != "nothing")
    if hurt in ("crc", "cut", "byte"):        # the ranges of a damaged member follow one another
        assert [a for a, *_ in rows] == [0] + [b for _, b, *_ in rows[:-1]] and rows[-1][1] == len(pack) + len(after)


def test_a_header_of_any_length_is_read():
    data = b"".join(W.member(W.make_record(i, "http://h/" + "é" * 300_000, b"x")) for i in range(2))
    assert [(page_id(r["record_id"]), why) for _, _, r, why in W.salvage(data)] == [(0, None), (1, None)]


def test_usual_file_names_are_read(spark, scratch):
    import os
    os.makedirs(f"{scratch}/w")
    for name, data in (("a.warc.gz", W.member(W.make_record(1, "u", b"x"))), ("b.warc", W.make_record(2, "u", b"y")), ("c.txt", b"no")):
        with open(f"{scratch}/w/{name}", "wb") as f:
            f.write(data)
    assert sorted(page_id(r.record_id) for r in W.read(spark, f"{scratch}/w").collect()) == [1, 2]
    assert [page_id(r.record_id) for r in W.read(spark, f"{scratch}/w", names_like="*.warc").collect()] == [2]


def test_gaps_are_logged(spark, scratch):
    import os
    os.makedirs(f"{scratch}/w")
    good = [W.member(W.make_record(i, "u", b"x" * i)) for i in range(3)]
    with open(f"{scratch}/w/part-0", "wb") as f:
        f.write(good[0] + b"garbage" + good[1] + good[2][:-9])
    rows = sorted(W.read(spark, f"{scratch}/w", with_payload=False).collect(), key=lambda r: r.start)
    with pytest.raises(Exception, match="gap in .*part-0 at [0-9]+: "):
        W.intact(W.read(spark, f"{scratch}/w")).collect()
    a, b = len(good[0]), len(good[0]) + 7
    assert [(r.start, r.end, r.gap is None) for r in rows] == [
        (0, a, True), (a, b, False), (b, b + len(good[1]), True), (b + len(good[1]), b + len(good[1]) + len(good[2]) - 9, False)]


def test_folded_header_lines_are_joined():
    rec = W.make_record(5, "http://h/a", b"body").replace(b"WARC-Date: ", b"X-Note: one\r\n two\r\n\tthree\r\nWARC-Date: ")
    for data in (rec, W.member(rec)):
        (_, _, record, why), *more = W.salvage(data)
        assert why is None and not more and page_id(record["record_id"]) == 5
    assert W.header_of(W.Whole(rec), 0)[0]["x-note"] == "one two three"


@pytest.mark.parametrize("packed", [True, False])
def test_records_inside_a_damaged_payload_are_no_records(packed):
    inner = W.make_record(50, "http://inner", b"embedded")
    outer = bytearray(W.make_record(1, "http://outer", b"before " + inner + b" after"))
    outer[outer.index(b"before")] ^= 1
    parts = [W.make_record(0, "u", b"a"), bytes(outer), W.make_record(2, "u", b"c")]
    data = gzip.compress(b"".join(parts)) if packed else b"".join(parts)
    rows = list(W.salvage(data))
    assert [page_id(r["record_id"]) if r else why for _, _, r, why in rows] == [0, "block digest", 2]
    # Without its own end the embedded record cannot be told from a real one.
    cut = b"".join([parts[0], bytes(outer)[:-7], parts[2]])
    assert [page_id(r["record_id"]) for _, _, r, _ in W.salvage(cut) if r] == [0, 50, 2]


def test_odd_lengths_and_long_lines_are_gaps():
    good = W.make_record(1, "u", b"x")
    for length in (b"9" * 5000, "²".encode(), b"-4", b"9" * 18, b""):
        bad = re.sub(rb"Content-Length: \d+\r\n\r\nHTTP", lambda m: b"Content-Length: " + length + b"\r\n\r\nHTTP", good)
        rows = list(W.salvage(bad + good))
        assert [r is None for _, _, r, _ in rows] == [True, False] and rows[0][1] == len(bad)
    junk = b"WARC/1.0\r\n" + b"\xff" * 3_000_000
    assert [(r is None, b) for _, b, r, _ in W.salvage(junk + good)] == [(True, len(junk)), (False, len(junk) + len(good))]


def archives():
    rnd = random.Random(11)
    plain = [W.make_record(i, f"http://h/{i}", bytes(rnd.choices(range(97, 123), k=rnd.choice((0, 10, 900, 5000))))) for i in range(60)]
    plain[20] = plain[20][:-30] + b"#" + plain[20][-29:]
    one = bytearray(gzip.compress(b"".join(plain), mtime=0))
    yield bytes(one)
    yield b"".join(map(W.member, plain)) + b"junk" + b"".join(plain)
    one[len(one) // 2] ^= 255
    yield bytes(one) + W.member(plain[0])
    yield bytes(one[:len(one) * 2 // 3])
    yield gzip.compress(b"".join(plain[:5]) + W.make_record(70, "u", b"y" * 400_000) + b"".join(plain[5:9]))


@pytest.mark.parametrize("chunk, part, held, marks", [(997, 61, 1500, 4), (4096, 512, 100, 3), (64, 33, 64, 8)])
def test_small_blocks_read_the_same(monkeypatch, chunk, part, held, marks):
    import io
    want = [list(W.salvage(x)) for x in archives()]
    assert sum(r is not None for x in want for _, _, r, _ in x) > 150
    for name, value in (("CHUNK", chunk), ("PART", part), ("HELD", held), ("MARKS", marks), ("BLOCKS", 2)):
        monkeypatch.setattr(W, name, value)
    assert [list(W.salvage(W.Opened(io.BytesIO(x), len(x)))) for x in archives()] == want
    bare = [[(a, b, r and {**r, "payload": None}, w) for a, b, r, w in x] for x in want]
    assert [list(W.salvage(x, with_payload=False)) for x in archives()] == bare


def test_inflated_bytes_are_read_anywhere(monkeypatch):
    for name, value in (("CHUNK", 500), ("PART", 70), ("HELD", 300), ("MARKS", 5)):
        monkeypatch.setattr(W, name, value)
    rnd = random.Random(4)
    text = bytes(rnd.choices(range(60, 123), k=40_000)) + b"z" * 40_000
    inner = W.Inflated(W.Whole(b"??" + gzip.compress(text) + b"rest"), 2)
    assert (inner.size, inner.bad, inner.end) == (80_000, None, 2 + len(gzip.compress(text))) and len(inner.marks) <= 5
    for _ in range(400):
        at, n = rnd.randrange(81_000), rnd.choice((1, 40, 2000))
        assert inner.get(at, n) == text[at:at + n]
    many = W.member(W.make_record(8, "u", b"x" * 3_000_000)) + W._EMPTY
    assert [(a, b, w) for a, b, _, w in W.salvage(many)] == [(0, len(many) - len(W._EMPTY), None)]
    assert inner.find(b"zzzz", 0) == 40_000 and inner.find(b"??", 40_000) == -1


def test_memory_does_not_grow_with_member_or_record(tmp_path):
    """One member of 300 MB with a record of 200 MB: some 40 MB at a time."""
    import subprocess
    import sys
    path = tmp_path / "one.warc.gz"
    with gzip.open(path, "wb", compresslevel=1) as f:
        for i in range(100):
            f.write(W.make_record(i, "u", b"%09d" % i * 110_000))
        f.write(W.make_record(100, "u", b"abcdefgh" * 25_000_000))
    code = ("import resource, os\nfrom tickspan.llm import warc as W\n"
            "base = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
            f"p = {str(path)!r}\n"
            "rows = [(r['record_id'], r['payload_bytes']) for _, _, r, w in W.salvage(W.Opened(open(p, 'rb'), os.path.getsize(p)), False) if not w]\n"
            "print(len(rows), rows[-1][1], (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - base) // 1024)")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                         cwd=str(pathlib.Path(W.__file__).parents[2])).stdout.split()
    assert out[:2] == ["101", "200000000"] and int(out[2]) < 80


def test_large_files_are_read_in_blocks_and_give_the_same(spark, scratch):
    rows = [(i, f"http://h/{i}", "t" * i * 50) for i in range(200)]
    W.write(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{scratch}/w x%20", file_bytes=40_000)
    whole = collections.Counter(map(tuple, W.read(spark, f"{scratch}/w x%20").collect()))
    assert sum(whole.values()) == 200
    for at_most in (0, 3000):       # all files, and some of them
        assert collections.Counter(map(tuple, W.read(spark, f"{scratch}/w x%20", whole_bytes=at_most).collect())) == whole


# -- HTML

@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<script>x</script><!-- c -->", ""), ("plain  text", "plain text"),
    ("<p>a<p>b<b>c<p>d</b> e", "a\n\nbc\n\nd e"),
    ("<ul><li>one<li>two<ol start=3><li>x<li>y</ol><li>three</ul>tail", "- one\n- two\n  3. x\n  4. y\n- three\n\ntail"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td>kiwi fruit<td>12</table>after",
     "Name        Qty\napple       3\nkiwi fruit  12\n\nafter"),
    ("<table><tr><td colspan=2>wide cell<td>z<tr><td>a<td>b<td>c</table>", "wide cell  z\na  b       c"),
    ("<div>x<span hidden>no</span><span style='display: none'>no</span>y</div>z", "xy\nz"),
    ("<a title='hidden'>shown</a><input type=hidden value=v>", "shown"),
    ("<pre>  a\n   b</pre>q<br>r<br><br>s", "  a\n   b\n\nq\nr\n\ns"),
    ('a < b & c &lt; d <a href="x>y">link</a> <a "bad>t</a> u', "a < b & c < d link t u"),
    ("<table>foo<tr><td>a<table><tr><td>in</table><td>b</table>", "foo\n\na   b\nin"),
    ("<title>T</title><script>var a='</p>';</script>ok<!-- c --> <style>p{}</style>fin", "ok fin"),
    ("<h1>H</h1>text<h2>G</h2><blockquote>q1<p>q2</blockquote>end", "H\n\ntext\n\nG\n\n> q1\n>\n> q2\n\nend"),
    ("<dl><dt>t<dd>d<dt>u<dd>v</dl>", "t\n    d\nu\n    v"),
    ("<table><tr><td>open", "open"), ("</td></p></table>x</ul>", "x"), ("<li>lone</li><td>cell</td>", "- lone\ncell"),
    ("<p>caf&eacute;&nbsp;&#x41;</p>", "café\xa0A"),
])
def test_layout(page, text):
    assert H.rendered(page) == text


@pytest.mark.parametrize("page, text", [
    ("<html><head><title>T</title><body><p>text", "text"), ("<head><meta charset=u><p>a</p>b", "a\n\nb"),
    ("<head>\n<title>T</title>\nloose <b>x</b>", "loose x"), ("<head><noscript><div>n</head>text", "text"),
    ("<head><script>s</script><style>t</style></head><body>x", "x"), ("a<head>b<title>T</title>c", "abc"),
    ("<head><template><body>no</template><body>yes", "yes"), ("<head><noscript><p>n<body>yes", "yes"),
    ("<svg><title>t</title><desc>d</desc><path d=x /><text>one <tspan>two</tspan></text><text>3</text>no</svg> z", "one two 3 z"),
    ("<svg><defs><text>no</text></defs><foreignObject><p>in</p></foreignObject></svg>out", "in\n\nout"),
    ("<svg><title/><text>t</text></svg>u", "t u"), ("<svg><path><p>after", "after"), ("<svg><text>a</svg>b", "a b"),
    ("x <math><semantics><mi>a</mi><mo>+</mo><mn>1</mn><annotation>tex</annotation></semantics></math> y", "x a+1 y"),
    ("<a title=Bob's>visible</a> it's <b>here</b> '>' z", "visible it's here '>' z"),
    ("<a title = 'a>b' alt=x'y\">v</a> w", "v w"), ("<p title=Bob's hidden id=Al's>no</p>yes", "yes"),
])
def test_all_visible_text(page, text):
    assert H.rendered(page) == text


def test_depth_and_length_are_no_problem():
    assert H.rendered("<div>" * 30000 + "deep" + "</div>" * 30000) == "deep"
    assert H.rendered("<b>" * 30000 + "x" + "</i>" * 30000) == "x"
    assert H.rendered("<table><tr><td>" * 300 + "core").strip() == "core"
    assert H.rendered("<a \"" * 20000 + "z").endswith("z")
    long = " ".join(f"w{i}" for i in range(200000))
    assert H.rendered(f"<p>{long}</p>") == long


TOKENS = ["<p>", "</p>", "<div>", "</div>", "<ul>", "</ul>", "<li>", "</li>", "<table>", "</table>", "<tr>", "<td>", "</td>", "<b>", "</b>",
          "<br>", "<pre>", "</pre>", "<blockquote>", "</blockquote>", "<h1>", "</h1>", "<ol>", "</ol>", "<dl>", "<dd>", "<dt>", "</dl>", "<th>",
          "<tbody>", "</tr>", "one", " two ", "3 & 4", "é\n", "<!-- c -->"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(TOKENS), max_size=40))
def test_every_visible_word_is_rendered_once(tokens):
    want = collections.Counter(w for t in tokens if not t.startswith("<") for w in t.split())
    shown = re.findall(r"one|two|é|4|3|&", re.sub(r"(?m)^(?:[ >]|- |\d+\. )*", "", H.rendered("".join(tokens))))
    words = collections.Counter(shown)
    assert {w: words[w] for w in ("one", "two", "é", "&")} == {w: want[w] for w in ("one", "two", "é", "&")}


def test_extract(spark):
    rows = [(1, "<p>a<p>b"), (2, None), (2, ""), (None, "x"), (1, "<p>a<p>b"), (3, "<li>" * 1000)]
    df = spark.createDataFrame([(i, h, "t", 1) for i, h in rows], "page_id long, html string, text string, n_chars long")
    got = collections.Counter(tuple(r) for r in H.extract(df).collect())
    assert got == collections.Counter((i, H.rendered(h), len(H.rendered(h)), len(H.rendered(h).split("\n")) if H.rendered(h) else 0)
                                      for i, h in rows)
    assert H.extract(df.limit(0)).collect() == []


@pytest.mark.parametrize("page, text", [
    ("<p style='visibility:hidden'>a<b style='visibility:visible'>b</b>c</p>", "b"),
    ("<div style=visibility:hidden><p style='display:none;visibility:visible'>no</p>x</div>y", "y"),
    ("<style>.x{display:none} #k, p.z {visibility : hidden}</style><p class='a x'>1</p><p id=k>2</p><p class=z>3</p><div class=z>4</div>", "4"),
    ("<style>.x{display:none}</style><style>p.x{display:block}</style><p class=x>1</p><div class=x>2</div>", "1"),
    ("<style>.x{display:none!important}</style><p class=x style='display:block'>1</p><p>2", "2"),
    ("<style>/* .y{display:none} */ @media print{.y{display:none}} @import 'a'; h1>b{display:none}</style><p class=y>1</p><h1><b>2</b></h1>", "1\n\n2"),
    ("<style>[hidden]{color:red} b{display:none}</style><p hidden>1</p><i hidden style='display:inline'>2</i><b>3</b>", "2"),
    ("<p>late <b class=q>no</b></p><style>.q{display:none}</style>", "late"),
    ("<details><summary>S</summary><p>in</p></details><details open><summary>T</summary>out</details>", "S\nT\nout"),
    ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
    ("<ol><li>a<li value=7>b<li>c</ol>", "1. a\n7. b\n8. c"),
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C</table>", "A  B\n   C"),
    ("<table><tr><td>A<td rowspan=0>B<td>D<tr><td>EE<td>F<tr><td>G<td>H</table>", "A   B  D\nEE     F\nG      H"),
    ("<table><tr><td colspan=2 rowspan=2>AA<td>B<tr><td>C<tr><td>x<td>y<td>z</table>", "AA    B\n      C\nx  y  z")])
def test_visibility_and_spans(page, text):
    assert H.rendered(page) == text


def test_long_cells_are_wrapped_and_columns_stay_aligned():
    long = " ".join(f"word{i}" for i in range(40))
    lines = H.rendered(f"<table><tr><td>{long}<td>right<tr><td>a<td>b</table>").split("\n")
    at = lines[0].index("right")
    assert lines[-1].index("b") == at and all(len(x) <= 70 for x in lines)
    assert " ".join(" ".join(x[:at].split()) for x in lines[:-1]) == long
    assert H.rendered(f"<table><tr><td>a<td>{long}</table>") == "a  " + long
    assert H.rendered(f"<table><tr><td>{long}<td>r</table>", widest=1000) == long + "  r"
