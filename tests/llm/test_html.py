import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskloom.llm import html_main as H


def page(article, menu="Home About Contact Help Terms Privacy Jobs Press Blog"):
    return (f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/">{menu}</a></li></ul></nav>'
            f'<!-- ad --><div class="ad">Buy now</div><article><h1>Ti&amp;tle</h1>{article}</article><footer>&copy; x</footer></body></html>')


def text(html):
    zones = H.page_blocks(html)
    return "\n".join(t for z, t in zones if z == H.ARTICLE)


def test_blocks():
    assert text(page("<p>one <b>two</b>\n\n three<br><p>a &lt;b&gt; &#233;&nbsp;x<p>cut &am")) == "Ti&tle\none two three\na <b> é x\ncut &am"
    assert text("<article><header><h1>H</h1></header><p>x</p><aside>no</aside><form><input>no</form><div class='comments'><p>no</p><div>no</div></div><p>y</p></article>") == "H\nx\ny"
    assert text('<article><p>in <span class="cookie-notice">no</span> it</p><figure><figcaption>cap</figcaption></figure></article>') == "in\nit\ncap"
    assert text("<article><p>a<script>x<p>") == "a" and H.page_blocks("") == []
    assert text('<article><a title="a>b">k</a><p class="lead">m</p></article>') == "k\nm"


def test_hints_spare_wrappers_and_headlines():
    story = "<article><h1>H</h1><p>x y</p></article>"
    for c in ("has-sidebar", "no-sidebar", "content with-nav", "layout--no-sidebar", "sidebar", "banner page"):
        assert text(f'<body><div class="{c}"><div>pre</div>{story}<div class="menu">m</div></div></body>') == "H\nx y"
    assert text('<article><header class="entry-header"><h1>H</h1></header><div class="article-header">h</div><div class="left side">s</div><div class="share">no</div>t</article>') == "H\nh\ns\nt"
    # most of the page's text stays open; a small part, and comments with articles of their own, do not
    assert H.page_blocks('<body><div class="widget"><p>all the words of this page</p></div><div class="widget">ad</div></body>') == [(H.OPEN, "all the words of this page"), (H.DROPPED, "ad")]
    assert H.page_blocks('<body><div>a long story told outside</div><div class="comments"><article>c</article></div></body>') == [(H.OPEN, "a long story told outside"), (H.DROPPED, "c")]


def brute_cover(tokens, page, depth):
    cover = [False] * len(tokens)
    spots = {}
    for i in range(len(tokens) - depth + 1):
        if page[i] == page[i + depth - 1]:
            spots.setdefault(tuple(tokens[i:i + depth]), []).append(i)
    for at in spots.values():
        if len({page[i] for i in at}) > 1:
            for i in at:
                cover[i:i + depth] = [True] * depth
    return cover


def test_repeated_runs_equal_brute_force():
    rng = np.random.default_rng(5)
    for depth in (1, 2, 3, 5, 8):
        for _ in range(10):
            tokens = rng.integers(0, 3, 200)
            pages = np.sort(rng.integers(0, 9, 200))
            assert H.repeated_runs(tokens, pages, depth).tolist() == brute_cover(tokens.tolist(), pages.tolist(), depth)


def brute_counts(tokens, page, depth):
    spots, out = {}, [0] * len(tokens)
    for i in range(len(tokens) - depth + 1):
        if page[i] == page[i + depth - 1]:
            spots.setdefault(tuple(tokens[i:i + depth]), set()).add(page[i])
    for i in range(len(tokens) - depth + 1):
        if page[i] == page[i + depth - 1]:
            for k in range(i, i + depth):
                out[k] = max(out[k], len(spots[tuple(tokens[i:i + depth])]))
    return out


def test_run_counts_equal_brute_force():
    rng = np.random.default_rng(6)
    for depth in (1, 2, 3, 5, 8):
        for n in (0, 3, 200):
            tokens, pages = rng.integers(0, 3, n), np.sort(rng.integers(0, 9, n))
            assert H.run_counts(tokens, pages, depth).tolist() == brute_counts(tokens.tolist(), pages.tolist(), depth)


def brute_texts(pages, depth=8):
    """Main texts of the pages (html) of one host: runs counted over distinct pages, a quarter of them outside articles, half inside."""
    blocks = [[(z, t) for z, t in H.page_blocks(h or "") if z != H.DROPPED] for h in pages]
    distinct = sorted({tuple(t for _, t in b) for b in blocks if b})
    number = {d: k for k, d in enumerate(distinct)}
    tokens = [w for d in distinct for t in d for w in t.split(" ")]
    of = [k for k, d in enumerate(distinct) for t in d for _ in t.split(" ")]
    counts = brute_counts(tokens, of, depth)
    starts, at = {}, 0
    for k, d in enumerate(distinct):
        starts[k] = at
        at += sum(len(t.split(" ")) for t in d)
    need = {H.ARTICLE: max(5, -(-len(distinct) // 2)), H.OPEN: max(3, -(-len(distinct) // 4))}
    out = []
    for b in blocks:
        at, fresh = starts.get(number.get(tuple(t for _, t in b)), 0), []
        for z, t in b:
            n = len(t.split(" "))
            fresh.append(sum(c >= need[z] for c in counts[at: at + n]) < 0.8 * n)
            at += n
        words = {zone: sum(len(t.split(" ")) for (z, t), f in zip(b, fresh) if f and z == zone) for zone in (H.ARTICLE, H.OPEN)}
        both = not words[H.ARTICLE] or words[H.ARTICLE] < 0.2 * sum(words.values())
        out.append("\n".join(t for (z, t), f in zip(b, fresh) if f and (z == H.ARTICLE or both)))
    return out


def texts_of(spark, rows, **how):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("section", F.lit(1)).withColumn("many", F.lit("x"))
    return sorted(((r["page_id"], r["text"]) for r in H.main_text(df, **how).collect()), key=str)


NOTICE = "We use small files on your device to make this very site work well for you"


def words(tag, n):
    return " ".join(f"{tag}w{k}" for k in range(n))


def test_notice_inside_articles_goes(spark):
    """A notice on all pages of a host goes even inside their articles; a passage that some pages quote stays."""
    rows = [(i, f"http://h.example/{i}", page(f"<p>{words(f's{i}', 20)}</p><p>{NOTICE}</p>" + (f"<p>{words('quoted', 60)}</p>" if i % 4 == 0 else ""))) for i in range(40)]
    for i, t in texts_of(spark, rows):
        assert t == f"Ti&tle\n{words(f's{i}', 20)}" + (f"\n{words('quoted', 60)}" if i % 4 == 0 else "")


def test_story_beside_teaser_cards_stays(spark):
    rows = [(i, f"http://h.example/{i}", f"<body><article><h2>Teaser {i % 3}</h2></article><div><p>{words(f'a{i}', 30)}</p><p>{words(f'b{i}', 30)}</p></div><footer>f</footer></body>") for i in range(10)]
    for i, t in texts_of(spark, rows):
        assert t.endswith(f"{words(f'a{i}', 30)}\n{words(f'b{i}', 30)}")


def test_copies_keep_their_text(spark):
    story = f"<body><div>{words('s', 40)}</div><div>{words('t', 40)}</div></body>"
    rows = [(1, "http://a.example/1", story), (2, "http://a.example/1", story), (None, "http://a.example/1", story)] + [(7, "http://b.example/x", story)] * 30
    rows += [(100 + i, "http://c.example/", f"<body><div>{words(f'c{i}', 12)}</div></body>") for i in range(3)]
    got = texts_of(spark, rows)
    assert got == sorted([(i, f"{words('s', 40)}\n{words('t', 40)}") for i, _, h in rows if h == story] + [(100 + i, words(f"c{i}", 12)) for i in range(3)], key=str)


def host_rows(n=60):
    rng = np.random.default_rng(8)
    rare = [words(f"r{k}", 12) for k in range(20)]
    rows = []
    for i in range(n):
        own = words(f"o{i}", 10)
        parts = [own, rare[rng.integers(20)], "short one", NOTICE if i % 3 else words(f"n{i}", 9)]
        body = "".join(f"<div>{parts[k]}</div>" for k in rng.permutation(4))
        inner = f"<p>{own}</p>" + (f"<p>{NOTICE}</p>" if i % 2 else "") + (f"<p>{rare[0]}</p>" if i % 7 == 0 else "")
        rows.append((i, "http://h.example/x", f"<body>{body}</body>" if i % 5 > 1 else page(inner, menu=parts[1])))
    return rows


def test_query_equals_brute_force(spark, tmp_path):
    """Pages with and without articles: shares of the host's distinct pages decide."""
    from riskloom.llm.queries import op7_host_suffix_array
    rows = host_rows() + [(i, "http://h.example/copy", host_rows()[3][2]) for i in range(200, 230)] + [(500, "http://h.example/", None), (None, None, page("<p>n</p>"))]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in op7_host_suffix_array(spark, str(tmp_path)).collect()), key=str)
    want = []
    for host in ("h.example", None):
        mine = [r for r in rows if (r[1] is None) == (host is None)]
        want += [(r[0], t, len(t)) for r, t in zip(mine, brute_texts([r[2] for r in mine]))]
    assert got == sorted(want, key=str)
    assert any(NOTICE not in t and r[2] and NOTICE in r[2] for r, (_, t, _) in zip(rows, want))      # some notices went


def test_sections_split_hosts_and_null_ids(spark):
    """A host of many pages, ids and urls null, lies in many sections; each is a host of its own for the shares."""
    rows = [(None, None, f"<body><div>{words(f'p{i}', 30)}</div><div>{NOTICE}</div></body>") for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(r["text"] for r in H.main_text(df, shard_pages=50).collect()) == sorted(words(f"p{i}", 30) for i in range(300))
    assert sorted(r["text"] for r in H.main_text(df, shard_bytes=20_000).collect()) == sorted(words(f"p{i}", 30) for i in range(300))


def test_very_long_page_and_empty(spark):
    rows = [(1, "http://a.example/", "<article>" + "".join(f"<p>{words(f'l{i}', 20)}</p>" for i in range(20_000)) + "</article>"), (2, "http://a.example/", ""), (3, "x", None)]
    got = dict(texts_of(spark, rows))
    assert got[1].count("\n") == 19_999 and (got[2], got[3]) == ("", "")
    assert texts_of(spark, []) == []


def test_sections_do_not_change_the_result(spark):
    """Shares are those of the whole host, however many sections it is dealt over: runs near the thresholds, in and outside articles."""
    rows = []
    for i in range(240):
        shown = [f"<div>{words(f'q{k}', 12)}</div>" for k in range(40) if (i * 7 + k) % 240 < 50 + k // 2]
        inner = "".join(f"<p>{words(f'a{k}', 12)}</p>" for k in range(20) if (i * 11 + k) % 240 < 110 + k)
        rows.append((i, "http://h.example/", f"<body>{''.join(shown)}<div>{words(f'o{i}', 15)}</div></body>" if i % 2 else page(f"<p>{words(f's{i}', 9)}</p>{inner}")))
    rows += [(1000 + i, "http://h.example/", rows[i][2] + f"<!-- {i} -->") for i in range(60)]        # equal blocks, other html
    want = sorted(zip([r[0] for r in rows], brute_texts([r[2] for r in rows])), key=str)
    for how in ({}, {"shard_pages": 16}, {"shard_pages": 61}, {"shard_bytes": 20_000}):
        assert texts_of(spark, rows, **how) == want, how


def test_blocks_are_packed_on_the_way():
    """What a parsed page takes to the shuffle: its blocks compressed (whole before), and they come back as they were."""
    rng = np.random.default_rng(3)
    known = ["".join(rng.choice(list("abcdefghijklmnoprstuvé"), rng.integers(2, 9))) for _ in range(800)]
    stories = ["\n".join(" ".join(rng.choice(known, 60)) for _ in range(8)) for _ in range(40)] + ["", "x"]
    htmls = ["".join(f"<p>{x}</p>" for x in t.split("\n")) for t in stories]
    n = len(htmls)
    one = pa.array([1] * n, pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array([7] * n, pa.int32()), one, one, one, pa.array([False] * n), one, pa.array(["u"] * n), pa.array(htmls)], names=[*H.CARRIED[1:], "html"])
    out = pa.Table.from_batches(H._parse(iter([batch]))).combine_chunks()
    moved = sum(out.column(c).nbytes for c in out.schema.names if c not in H.CARRIED)
    assert moved < 0.75 * sum(len(t.encode()) for t in stories)
    assert H._unpacked(out.column("size"), out.column("packed")).to_pylist() == stories
