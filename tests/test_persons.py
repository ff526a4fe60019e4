"""Person templates and whole chains of overrides on written-out cases."""

from catalogloom.operators import overlay, persons

PAGE = """Intro {{Other|Born Year=1}} <!-- {{#fte:person |Born Year=2}} -->
{{#fte:performer
|Born Year= 1861 |Died Year=c.1930
|Biography Link=[[wikipedia:en:Ann Bell|Bell]] and {{x|[[a|b]]}}
|Alternate Names={{AltNames|{{FN|Anna|Bell}}|[[Category:X|A. Belle]]}}, Anna Bell<br>Ännchen
|Note=[[open |Born Year=3}}
|Died Year=1999}}"""


def test_templates(spark):
    rows = [
        (1, PAGE),
        (2, "{{#imslpcomposer: |Born Year=1850/51|Died Year=1900|Biography Link={{wp|Carl_D|x}}"),
        (3, "{{#fte:composer|biography link=[[w:de:Karl]]|DIED YEAR=77}}"),
        (4, "{{#fte:person|Biography Link=see https://en.wikipedia.org/wiki/E_F] etc}}"),
        (5, "{{#fte:personal|Born Year=1}}"),
        (6, ""),
        (7, None),
        (8, "{{#fte:person|Frequently=[[wikipedia:Wrong]]|Born Year=]] 12}} |Died Year=5"),
    ]
    df = spark.createDataFrame(rows, "k int, source string")
    got = {r.k: tuple(r)[1:] for r in persons.person_pages(df, "k", "source").collect()}
    assert got[1] == ("performer", 1861, None, "Ann Bell", ["Anna Bell", "A. Belle", "Ännchen"])
    assert got[2] == ("imslpcomposer", None, 1900, "Carl_D", [])
    assert got[3] == ("composer", None, 77, "", [])
    assert got[4] == ("person", None, None, "E_F", [])
    assert got[5] == got[6] == got[7] == ("none", None, None, "", [])
    assert got[8] == ("person", None, None, "", [])


def test_trees_of_pages():
    source = "a {{b|c={{d|e}}|[[f|g]]}} [[h|{{i}} | j]] }} ]] [[open {{k|[[l}} m"
    tree = persons.tree(source)
    assert persons.source_of(tree.parts[0]) == source
    assert [n.source() for n in persons.nodes(tree.parts[0], "{{")] == ["{{b|c={{d|e}}|[[f|g]]}}", "{{d|e}}", "{{i}}", "{{k|[[l}}"]
    assert persons.source_of(persons.tree("x<!-- {{a}} <!-- -->y<!-- z").parts[0]) == "xy"
    assert persons.tree("").parts == [[]]


def test_odd_templates():
    p = persons.person
    assert p("{{wrap|{{#FTE : Composer x|Born Year=1700}}}}") == ("composer", 1700, None, "", [])
    assert p("{{#fte:person|Born Year={{y|1700}}|Died Year=17000|Biography Link={{wp|de:A}}|Alternate Names=[[a|b|c]], {{other|x}}<BR>N"  ) == ("person", None, None, "", ["b", "c", "{{other", "x}}", "N"])
    assert p("{{#fte:person|Biography Link=[[b]] [[W : En:A_b]] [[wikipedia:c]]|Alternate Names={{AltNames|{{RFNspace|A| |B}}|[[c]]}}}}") == ("person", None, None, "A_b", ["A B", "c"])
    assert p("{{#fte:person|Biography Link=[[w:de:A]] {{wp|B}}}}")[3] == "" and p("{{#fte:person|Biography Link={{wp| B c |d}}}}")[3] == "B c"
    assert p("{{#fte:person|Biography Link=//en.wikipedia.org/wiki/A_(b) x}}")[3] == "A_(b)"


def test_overrides_in_order(spark):
    people = spark.createDataFrame([("a", "1900", "f", "x", 0, -1, "", "C1"), ("Q2", "1990", "", "x", 0, -1, "", "C2"), ("c", "", "", "x", 0, -1, "", "C3"), ("d", "1", "", "x", 0, -1, "", "C4")], "id string, death_year string, qa_flags string, eu_pd_status string, eu_pd_year int, n_works long, present string, category string")
    works = spark.createDataFrame([("a", "F"), ("a", "O"), ("old2", "P"), ("Q2", "F"), ("d", "F"), ("e", "F")], "id string, category string")
    overrides = spark.createDataFrame(
        [("a", "rekey", "new"), ("a", "death_year", "1980"), ("old2", "rekey", "Q2"), ("old2", "death_year", ""), ("d", "_drop", ""), ("unknown", "death_year", "3")], "key string, field string, value string"
    ).selectExpr("*", "'2024-01-01' AS date")
    documents = spark.createDataFrame([("Q2", ("C2", "1950"))], "id string, e struct<category: string, death_year: string>")
    out, following = overlay.apply_in_order(people, works, overrides, documents, "id", ["death_year"], {"death_year": "death_year"}, 2026, "category", ["O", "F", "P"])
    got = {r.id: tuple(r)[1:] for r in out.collect()}
    assert got == {
        "new": ("1980", "manual_override|f", "not_pd", 2051, 2, "O|F", "C1"),
        "Q2": ("", "manual_override", "unknown_death", None, 2, "F|P", "C2"),
        "c": ("", "", "x", 0, -1, "", "C3"),
    }
    assert sorted(r.id for r in following.collect()) == ["Q2", "Q2", "e", "new", "new"]
