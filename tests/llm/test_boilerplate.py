import random

import pytest

from tamarack.llm import boilerplate as B
from tamarack.llm import residue as R

SCHEMA = "page_id bigint, url string, title string, text_content string, host string, path string, kind string"
BODY = "The truck climbed the ramp at 12 km/h in trial {i}. The loader moved 300 tonnes in {i} hours."


def page(i, lines, url=None, title="T"):
    return (i, url or f"https://site.example/p/{i}", title, None if lines is None else "\n".join(lines), "h", "p", "k")


def found(spark, rows):
    out = {}
    for r in B.boilerplate(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect():
        out.setdefault(r.page_id, []).append(r.line_no)
    return {k: sorted(v) for k, v in out.items()}


def test_shared_lines_go_and_content_stays(spark):
    rows = [page(i, ["Acme Portal", "Prices and stock", "", f"T{i}", BODY.format(i=i), "Dimensions", f"Engine power: {i}00 kW", "Top speed", f"{i}0 km/h", "- Item one is listed here.", "Depot opening hours", "© 2024 Acme"], title=f"T{i}") for i in range(1, 6)]
    got = found(spark, rows)
    assert all(v == [1, 2, 11, 12] for v in got.values()) and len(got) == 5


def test_kinds_without_neighbours(spark):
    lines = ["Menu · Parts · Events", "T", BODY.format(i=1), "Advertisement", "Photo 3 of 9", "Related models", "Operating weight (12)", "Reach (3)", "Overview", "Read also: Something happened.", "Terms of use | Privacy", "We use cookies to improve this site. Accept all", "Site, 12 Quarry Road, Unit 3"]
    assert found(spark, [page(1, lines)]) == {1: [1, 4, 5, 6, 7, 8, 10, 11, 12, 13]}


def test_notices_in_place_of_content_stay(spark):
    rows = [page(i, ["Home", "404 – Page not found", "It may have been moved or deleted.", "© 2024 Site"], title="Other") for i in (1, 2)]
    assert found(spark, rows) == {1: [1, 4], 2: [1, 4]}


def test_edges(spark):
    rows = [page(1, None), page(2, [""]), (3, None, None, "a\n\nb", None, None, None), (None, "not an address", "T", "x" * 300_000, None, None, None), page(4, ["T", " ", "\t"])]
    assert found(spark, rows) == {}
    assert B.boilerplate(spark.createDataFrame([], SCHEMA)).count() == 0
    twice = [page(1, ["Nav", "T", BODY.format(i=1)]), page(1, ["Nav", "T", BODY.format(i=1)])]
    assert found(spark, twice) == {1: [1, 1]}
    assert {r.page_id: r.body for r in B.bodies(spark.createDataFrame(twice[:1] + [page(5, None)], SCHEMA)).collect()} == {1: "T\n" + BODY.format(i=1), 5: None}


def test_copies_and_edges_of_tasks_have_neighbours_on_both_sides(spark):
    lines = lambda i: ["Depot opening hours", "T", BODY.format(i=i), "Spare parts desk"]
    copies = [page(i, lines(1), "https://site.example/a") for i in range(2500)]
    rows = [*copies, page(9000, lines(2), "https://site.example/b"), page(9001, None, "https://site.example/c"), page(9002, lines(3), "https://other.example/a")]
    df = spark.createDataFrame(rows, SCHEMA)
    for frame in (df.coalesce(1), df.repartition(7)):
        got = {}
        for r in B.boilerplate(frame).collect():
            got.setdefault(r.page_id, []).append(r.line_no)
        assert {k: sorted(v) for k, v in got.items()} == {**{i: [1, 4] for i in range(2500)}, 9000: [1, 4], 9002: [1]}


def test_blocks_of_pages_overlap(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCK", 3)
    words = "alfa brava carga delta elevo faena".split()
    rows = [page(i, ["T", BODY.format(i=words[i % 6] * (i + 1)), f"Desk {words[i // 2 % 6]}{chr(97 + i // 2)}"], f"https://site.example/{chr(97 + i // 26)}{chr(97 + i % 26)}") for i in range(40)]
    assert found(spark, rows) == {i: [3] for i in range(40)}  # every page shares its last line with one neighbour only


def test_forms_shared_on_other_hosts_go_from_lone_pages(spark):
    words = "alfa brava carga delta elevo faena gusto hecho india julia".split()
    lines = lambda i: ["T", f"Crew {words[i % 10]}{'x' * (i // 10)} wrote this report after the night shift was over.", "Prices may change at any time without any notice to you.", f"Note {words[i % 10]}{i // 10 * chr(121)}"]
    rows = [page(10 * h + i, lines(10 * h + i), f"https://host{'abc'[h]}.example/{i}") for h in range(3) for i in range(3)] + [page(99, lines(99), "https://lone.example/x")]
    got = found(spark, rows)
    assert got.pop(99) == [3] and all(3 in v for v in got.values())
    without = B.boilerplate(spark.createDataFrame(rows, SCHEMA), near=0)
    assert without.count() == 0  # differencing decides it


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], prev + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@pytest.mark.parametrize("trace", [1 << 26, 64])
@pytest.mark.parametrize("seed", range(40))
def test_common_lines_against_the_table(seed, trace, monkeypatch):
    monkeypatch.setattr(B, "TRACE", trace)  # small: halved again and again
    rng = random.Random(seed)
    a, b = ([rng.choice("abcdef") for _ in range(rng.randint(0, 90))] for _ in range(2))
    hit = B.common_lines(a, b)
    chosen = [x for x, h in zip(a, hit) if h]
    assert len(chosen) == lcs_length(a, b)
    it = iter(b)
    assert all(any(x == y for y in it) for x in chosen)  # a subsequence of b


SLOTS = ["Reach: {{product.reach}} ton", "${spec.weight}", "<%= machine.reach %>", "%%TITLE%%", "Reach: (((digging_depth)))", "Swing: __SWING__", "[object Object]", "#REF!", "Pump flow: NaN kN", "Reach: undefined kg", "[INSERT TOP SPEED]", "Dear %FIRSTNAME%, thanks", "i18n.product.reach.label", "Width: @Model.Width", "The {model_name} delivers {top_speed}", "<pump_flow>", "{% if reach %}x{% endif %}", "Weight: XXXX kg"]
PLAIN = ["Grade is 9% * rise / run, and at 4 it gave 9 %.", "Type <ESC> twice to leave menu 4.", 'A payload such as {"rpm": 9, "bar": 3} is sent.', "The template writes {unit} where the number goes.", "Pump line [optional] is fitted.", "Load is undefined on slopes.", "Error 9-4 is logged when the retarder stays.", "A placeholder plug closes port 9.", "Access to the deck is denied by the gate switch."]


@pytest.mark.parametrize("line", SLOTS)
def test_slots(line):
    assert R.slots(line)


@pytest.mark.parametrize("line", PLAIN)
def test_plain_lines(line):
    assert not R.slots(line) and R.classify(R.shape(line), 40, 4, 0) == ""


@pytest.mark.parametrize("line", ["Lorem ipsum dolor sit amet", "Duis aute irure dolor in voluptate velit esse cillum", "test test 4 dummy text", "Insert image caption here", "Hier steht später der Text.", "TODO: ask for copy", "lorem, ipsum, dolor, sit, amet", "Lorem lorem lorem lorem lorem"])
def test_filler(line):
    words = "the shift report of the north pit goes here and is kept until the next crew has read it " * 3
    assert R.classify(R.shape(line), 1, 0, 0) == "filler"
    assert "orem" in line or "aute" in line or line.endswith(("text", "here")) or R.classify(R.shape(line + " " + words), 1, 0, 0) == "filler"  # long lines too


def test_pages(spark):
    long = BODY.format(i=1) * 20
    rows = [
        page(1, ["T", "Access denied", "You do not have permission to open this document on this server."]),
        page(2, ["T", long, "The page of the log book was not found again."]),
        page(3, ["Please enable JavaScript for the best experience on this site.", "T", long]),
        page(4, None), page(5, [""]), page(6, ["T", long, "Reach: {{reach}}"]), page(7, ["Site under maintenance"], title="Site under maintenance"), page(8, ["T", "x" * 300_000]), page(None, ["T", "Bad gateway"]),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.page_id for r in R.residue(df).collect()} == {1, 6, 7, None}
    assert {r.page_id for r in R.without_residue(df).collect()} == {2, 3, 4, 5, 8, None}
    assert R.residue(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_tree_makes_templates():
    leaf = R.Leaf()
    lines = ["We looked everywhere for DX-R9 but it is gone", "We looked everywhere for the loader but it is gone", "We looked everywhere for KV L200 but it is gone", "We looked everywhere and found nothing of the kind here"]
    by_path = {}
    for x in lines:
        by_path.setdefault(R.path_of(R.shape(x)), []).append(R.shape(x).split(" "))
    assert sorted(map(len, by_path.values())) == [1, 3]
    same = ["a b c d e f g h".split(), "a b c d e f g i".split(), "a b c w x y z z".split()]
    assert [leaf.add(list(t)) for t in same] == [0, 0, 1] and leaf.templates[0] == "a b c d e f g *".split()


def test_a_template_that_stands_alone_is_a_notice_and_one_among_text_is_not(spark):
    long = [BODY.format(i=i) * 9 for i in range(4)]
    rows = [page(i, ["T", "The valve page was not found on bus 4."] + long, f"https://h{i}.example/") for i in range(6)]
    rows += [page(10, ["T", "The valve page was not found on bus 7."], "https://x.example/")]  # short, but of a template that stands among text
    rows += [page(20 + i, ["T", f"Our vault door stays shut on night {i}, come tomorrow."], f"https://n{i}.example/") for i in range(6)]  # no list knows it
    rows += [page(30, ["T", *long, "The depot can be reached by road."], "https://y.example/")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.page_id for r in R.residue(df).collect()} == set(range(20, 26))
    assert R.verdicts(df, tree=False).where("kind != ''").count() == 0  # mining decides it
    for parts in (1, 5):
        assert {r.page_id for r in R.residue(df.repartition(parts)).collect()} == set(range(20, 26))


def test_long_notices_and_messages(spark):
    words = "the shift report of the north pit goes here and is kept until the next crew has read it " * 3
    rows = [page(1, ["404 – Page not found. " + words]), page(2, ["Title", "Traceback (most recent call last): " + words * 4]), page(3, ["Title", BODY.format(i=1) * 9, "Warning: Undefined array key 3 " + words]), page(4, ["This page has been removed from the index, " + words * 9])]
    rows = [(i, f"https://h{i}.example/", "other", *r[3:]) for i, r in enumerate(rows, 1)]
    assert {r.page_id for r in R.residue(spark.createDataFrame(rows, SCHEMA)).collect()} == {1, 2, 3}
