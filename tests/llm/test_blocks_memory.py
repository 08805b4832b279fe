"""A very long page among short ones takes no more memory than its own blocks."""

import tracemalloc

from trawl.llm import blocks


def page(n, words=12):
    return "<html><body><article>" + "".join(f"<p>{'word ' * words}{i}.</p>" for i in range(n)) + "</article><nav><a href=x>menu</a></nav></body></html>"


def test_long_page_among_short_ones():
    short, long = [page(3 + i % 5) for i in range(200)], page(60_000)
    assert len(long) > 4_000_000
    weights = blocks.train([blocks.leaf_blocks(p) for p in short[:8]], [blocks.page_labels(blocks.leaf_blocks(p)) for p in short[:8]], steps=3)
    group = [blocks.leaf_blocks(p) for p in short[:120]] + [blocks.leaf_blocks(long)] + [blocks.leaf_blocks(p) for p in short[120:]]
    tracemalloc.start()
    kept = blocks.judge(weights, blocks.Features(), group)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [len(k) for k in kept] == [len(g) for g in group]
    assert peak < 500e6
    # side by side or alone, a page gets the same verdicts
    assert kept[7] == blocks.judge(weights, blocks.Features(), [group[7]])[0] and blocks.judge(weights, blocks.Features(), [[], group[0], []]) == [[], kept[0], []]
