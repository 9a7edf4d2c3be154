"""The scan for the best content region against all regions, and pages that are hard on the reader."""

import random
import time

import pytest

from spanloom.llm.content import Page, main_text

NAMES = ["div", "p", "span", "a", "b", "li", "ul", "table", "td", "section"]


def _best(source, costs):
    """Text of the region with the greatest sum of words less costs; of equal ones that which ends first, then the shortest."""
    items = Page(source).items
    worth = []
    for kind, value, _, _, never in items:
        tag = kind == "tag" and (costs.get(value) or costs.get(("*", value[1]), 1.0))
        worth.append(-tag if kind == "tag" else 0 if never else len(value.split()))
    runs = [(sum(worth[i : j + 1]), -j, i, j) for j in range(len(items)) for i in range(j + 1)]
    top = max(runs, default=(0, 0, 0, 0))
    if top[0] <= 0:
        return ""
    blocks = {}
    for kind, value, block, _, never in items[top[2] : top[3] + 1]:
        if not never:
            blocks.setdefault(block, []).append(value if kind == "text" else " " if value[1] in ("br", "img") else "")
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


@pytest.mark.parametrize("seed", range(4))
def test_the_scan_finds_the_best_of_all_regions(seed):
    pick = random.Random(seed)
    costs = {("*", n): float(pick.randrange(1, 6)) for n in NAMES} | {("div", "p"): 0.5, ("ul", "li"): 4.0}
    several = 0
    for _ in range(150):
        parts = []
        for _ in range(pick.randrange(30)):
            name = pick.choice(NAMES)
            parts.append(pick.choice([f"<{name}>", f"</{name}>", "one ", "two three four ", "w " * pick.randrange(9), '<div class="comments">x</div>']))
        source = "".join(parts)
        assert main_text(source, costs) == _best(source, costs)
        several += 0 < len(main_text(source, costs)) < len(main_text(source, {("*", n): 0.001 for n in NAMES}))
    assert several > 20  # regions that are not the whole page


def test_menus_of_unlisted_names_stay_out_without_main_markup():
    menu = "".join(f'<tr><td><a href="{i}">item {i}</a></td></tr>' for i in range(12))
    body = "".join(f"<p>{'sentence words that tell a story ' * 9}{i}</p>" for i in range(3))
    source = f"<html><body><table class='q7'>{menu}</table><div class='zz'>{body}</div><table class='q8'>{menu}</table></body></html>"
    found = main_text(source, {("*", n): 3.0 for n in ("td", "/td", "tr", "/tr", "a", "/a", "table", "/table")} | {("*", "p"): 0.1, ("*", "/p"): 0.1})
    assert found.count("\n") == 2 and "item" not in found


def test_the_reader_takes_time_by_length():
    begun = time.process_time()
    page = "<div>" * 40_000 + "</x>" * 40_000 + "<span>" * 40_000 + "<p>" + "<b>" * 40_000 + "<div>w" + "</div>" * 90_000
    assert len(Page(page).items) > 150_000
    assert time.process_time() - begun < 20
