"""Documents in the shapes of the catalogue, read by its settings."""

import re

import pytest

from hustings.sources import catalogue


def read(spark, name, text):
    lines = spark.createDataFrame([(name, k, line) for k, line in enumerate(text.split("\n"))], "doc string, line_no int, text string")
    return sorted((r.okrsok, r.street, r.cls) for r in catalogue.section_rules(lines, name).collect())


def test_wrapped_numbers_and_page_numbers(spark):
    text = "Rozhodnutie\nVolebný okrsok 1\nVolebná miestnosť ZŠ\nUlica   Orientačné\nBotanická všetky\nDevínska cesta 1, 3,\n5, 7\n2\nVolebný okrsok 2\nUlica Orientačné\nKresánkova 1-9 nepárne\nV Bratislave 1.1.\nNiečo"
    assert read(spark, "ba_karlovaves", text) == [(1, "Botanická", "WHOLE"), (1, "Devínska cesta", "ENUM"), (2, "Kresánkova", "RANGE")]


def test_footnote_and_catch_all(spark):
    text = "Okrsok č. 1\nPrislúchajúce ulice: Balkánska, Gerulatská\nkolónia 4\n+ občania prihlásení na obec\nOkrsok č. 2\nPrislúchajúce ulice: Irkutská\nPoznámka: Voliči s trvalým pobytom\nMaďarská"
    assert read(spark, "ba_rusovce", text) == [(1, "Balkánska", "WHOLE"), (1, "Gerulatská kolónia", "ENUM"), (2, "Irkutská", "WHOLE")]


def test_two_columns_of_sections(spark):
    text = f"{'VOLEBNÝ OKRSOK č. 1:':<52}VOLEBNÝ OKRSOK č. 4:\n{'Ulice: Na barine':<52}Ulice: Pod násypom\n{'Borinská':<52}Vrančovičova 1-9\n{'':<52}Zidiny\nVolebné miestnosti sa nachádzajú"
    assert read(spark, "ba_lamac", text) == [(1, "Borinská", "WHOLE"), (1, "Na barine", "WHOLE"), (4, "Pod násypom", "WHOLE"), (4, "Vrančovičova", "RANGE"), (4, "Zidiny", "WHOLE")]


def test_columns_beside_the_streets(spark):
    text = "okrsok číslo\n01 Bebravská      ZŠ Bieloruská 1     9\n   Čiližská\n" + " " * 60 + "Bieloruská 1\n02 Dudvážska   Kaméliova"
    assert read(spark, "ba_podunajskebiskupice", text) == [(1, "Bebravská", "WHOLE"), (1, "Čiližská", "WHOLE"), (2, "Dudvážska", "WHOLE")]


def test_sections_on_pages_of_their_own(spark):
    text = "starosta určuje\nvolebný okrsok č. 1\npre ulice: Buzinská, Učňovská 2-8 párne\nV Košiciach\nstarosta určuje\nvolebný okrsok č. 2\npre ulice: Železiarenská\nV Košiciach\nstarosta"
    assert read(spark, "ke_saca", text) == [(1, "Buzinská", "WHOLE"), (1, "Učňovská", "RANGE"), (2, "Železiarenská", "WHOLE")]


def words(rows):
    """(y, {x: text}) rows to words."""
    return [("d", 1, float(x), float(y), w) for y, cells in rows for x, text in cells.items() for x, w in zip((x + 7 * k for k in range(99)), text.split(), strict=False)]


def test_top_anchored_table(spark):
    rows = [(10, {110: "9"}), (20, {10: "Volebný obvod", 110: "Volebný okrsok"}), (30, {120: "1", 270: "Tokajícka", 390: "1-9 nepárne"}), (40, {270: "Lingov", 390: "2,"}), (50, {390: "4"}), (60, {120: "2", 270: "Tokajícka", 390: "2-8"}), (70, {270: "Mgr. Novák, starosta"})]
    frame = spark.createDataFrame(words(rows), "doc string, page int, x double, y double, text string")
    got = catalogue.table_rules(frame, "ke_dargovskych_hrdinov").collect()
    assert sorted((r.okrsok, r.street, r.cls) for r in got) == [(1, "Lingov", "WHOLE"), (1, "Tokajícka", "RANGE"), (2, "Tokajícka", "RANGE")]


def test_centred_table(spark):
    rows = [(5, {60: "3"}), (10, {60: "Číslo", 125: "Územie patriace do volebného okrsku"}), (20, {125: "Jantárová 1-9, Gemerská"}), (30, {60: "1"}), (40, {125: "Krivá 2, 4"}), (60, {125: "Alejová,"}), (65.5, {60: "2"}), (71, {125: "Milosrdenstva"})]
    frame = spark.createDataFrame(words(rows), "doc string, page int, x double, y double, text string")
    got = catalogue.table_rules(frame, "ke_juh").collect()
    assert sorted((r.okrsok, r.street) for r in got) == [(1, "Gemerská Krivá"), (1, "Jantárová"), (2, "Alejová"), (2, "Milosrdenstva")]


def test_columns_by_header_words(spark):
    """Pages shifted against each other, a street in two precincts, register numbers, a page without a header."""
    page = lambda dx: [(0, {10 + dx: "REFERENDUM 1. 1."}), (10, {20 + dx: "Okrsok", 90 + dx: "Názov", 250 + dx: "Orientačné"})]
    first = page(0) + [(20, {100: "Havanská", 200: "1-9 nepárne"}), (30, {22: "1"}), (40, {100: "Čínska", 260: "2"}), (60, {200: "s. č. 771"}), (72, {24: "2."}), (80, {100: "Havanská", 200: "2-8"})]
    second = page(120) + [(20, {150: "3", 200: "Ázijská", 300: "všetky"}), (40, {310: "55"})]
    third = [(20, {30: "9", 100: "Bez hlavičky"})]
    rows = [(d, n, x, y, w) for n, p in enumerate((first, second, third), 1) for d, _, x, y, w in words(p)]
    frame = spark.createDataFrame(rows, "doc string, page int, x double, y double, text string")
    got = catalogue.table_rules(frame, "ke_sidlisko_tahanovce").collect()
    assert sorted((r.okrsok, r.street, r.cls, {"RANGE": lambda s: (s.raw, s.ranges[0].parity), "ENUM": lambda s: tuple(s.singles), "WHOLE": lambda s: ""}[r.cls](r.spec)) for r in got) == [
        (1, "Havanská", "RANGE", ("1-9", "odd")), (1, "Čínska", "WHOLE", ""), (2, "", "ENUM", ("771",)), (2, "Havanská", "RANGE", ("2-8", "both")), (3, "", "ENUM", ("55",)), (3, "Ázijská", "WHOLE", ""),
    ]


def test_counts(spark):
    rules = spark.createDataFrame([("krasna", k) for k in (1, 2, 3, 4, 4)] + [("barca", 1)], "mcnorm string, okrsok int")
    got = {r.mcnorm: (r.rules, r.okrsky, r.flag) for r in catalogue.count_check(rules, catalogue.expected(spark)).collect()}
    assert got["krasna"] == (5, 4, "ok") and got["barca"] == (1, 1, "short") and got["raca"] == (0, 0, "missing") and got["total"][0] == 6


@pytest.mark.parametrize("name", sorted(catalogue.SECTIONS))
def test_patterns_compile(name):
    for k, v in catalogue.settings(catalogue.SECTIONS[name]).items():
        if isinstance(v, str):
            re.compile(v)
