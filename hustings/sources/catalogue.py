"""Settings of the municipal documents: which engine reads each, and what its lines and columns look like.

A source is read with `section_rules` (lines of text) or `table_rules` (words with places); both return the rules of
its documents with mc and mcnorm. `expected` has the number of precincts each source should give, and 0 where none is stated.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.operators import documents

#: Area, precincts and line patterns of the documents that list streets in sections.
SECTIONS: dict[str, dict[str, Any]] = {
    "ke_barca": {
        "mc": "Košice-Barca", "mcnorm": "barca", "expected": 3, "header": r"^okrsok č\.\s*(\d+)\s*$", "streets_after": r"^Zoznam ulíc\s*:",
        "stop": r"^Ing\. Gabriel Krištof|^starosta", "skip": r"^Volebná miestnosť|^\s*Abovská č\.|^\s*Barčianska č\.",
    },
    "ke_krasna": {"mc": "Košice-Krásna", "mcnorm": "krasna", "expected": 4, "header": r"^Okrsok č\.\s*(\d+)\s*:", "streets_after": r"tvoria ulice\s*:", "stop": r"^V Košiciach|starosta"},
    "ke_kosicka_nova_ves": {
        "mc": "Košice-Košická Nová Ves", "mcnorm": "kosicka nova ves", "expected": 2, "header": r"^Volebný okrsok č\.\s*(\d+)\s*[–-]",
        "streets_after": r"^Pre občanov s trvalým pobytom na uliciach\s*:", "stop": r"^V Košiciach|starosta",
    },
    "ke_saca": {"mc": "Košice-Šaca", "mcnorm": "saca", "expected": 3, "header": r"^volebný okrsok č\.\s*(\d+)\s*$", "streets_after": r"pre ulice\s*:", "end_section": r"^V Košiciach"},
    "ke_myslava": {"mc": "Košice-Myslava", "mcnorm": "myslava", "expected": 2, "header": r"^VOLEBNÝ OKRSOK\s*(\d+)\s*$", "streets_after": r"^Ulice\s*:", "per_line": True, "stop": r"^V Košiciach|starosta"},
    "ke_vysne_opatske": {
        "mc": "Košice-Vyšné Opátske", "mcnorm": "vysne opatske", "expected": 3, "header": r"^ZOZNAM ULÍC OKRSOK č\.\s*(\d+)", "per_line": True, "two_up_at": 100,
        "skip": r"^Mestská časť|^Nižná úvrať \d|^_+$|^Určenie volebných|^Okrsok č\.|^Telefón|^\+421|^055[\s\/]|podatelna@|^www\.|^Fax\b|^IČO|^Internet|^E-mail|^\d{4} \d{2} \d{2}$|^Spoločenská sála|^Spojená škola|^Kaviareň",
    },
    "ke_zapad": {
        "mc": "Košice-Západ", "mcnorm": "zapad", "expected": 31, "start_after": r"utváram volebné okrsky", "header": r"^(\d+)\.\s+\D.*$", "per_line": True,
        "stop": r"^Pozn\.|^V Košiciach|^Mgr\.|^Zverejnené",
    },
    "ke_tahanovce": {
        "mc": "Košice-Ťahanovce", "mcnorm": "tahanovce", "expected": 2, "start_after": r"^VOLEBNÁ MIESTNOSŤ$", "header": r"^(\d+)$", "per_line": True, "stop": r"^UPOZORNENIE",
        "skip": r"^(?:Kultúrny dom|Základná škola)|^\d{3} \d{2} |^\S+ \d+[A-Za-z]?$",
    },
    "ba_staremesto": {
        "mc": "Bratislava-Staré Mesto", "mcnorm": "staremesto", "expected": 34, "header": r"^Miestom konania volieb okrsku č\.\s*(\d+)\s*je\s*:", "streets_after": r"^pre oprávnených voličov",
        "per_line": True, "continued": r"^\d", "stop": r"^Informácia pre voliča|^V Bratislave|^Ing\. |^starosta|^Volič |dopustí priestupku",
    },
    "ba_novemesto_prose": {
        "mc": "Bratislava-Nové Mesto", "mcnorm": "novemesto", "expected": 32, "header": r"^Volebný okrsok č\.\s*(\d+)\s*$", "streets_after": r"Vymedzenie územia okrsku\s*:",
        "stop": r"^V Bratislave|^Mgr\. |^starosta",
    },
    "ba_raca": {
        "mc": "Bratislava-Rača", "mcnorm": "raca", "expected": 0, "header": r"^Volebný okrsok\s*(\d+)\b", "streets_after": r"^ulice\s*:", "stop": r"^V Bratislave|^Mgr\. |^starosta|^Príloha",
        "skip": r"^(?:sa vol[ií]|Vo volebnom obvode|Počet volených poslancov|\d{1,3}$)",
    },
    "ba_vrakuna": {
        "mc": "Bratislava-Vrakuňa", "mcnorm": "vrakuna", "expected": 14, "header": r"^Volebný okrsok č\.\s*(\d+)\s*$", "streets_after": r"^ulice\s*:", "stop": r"^V Bratislave|^Ing\. |^starosta",
        "skip": r"^(?:VOLEBNÝ OBVOD|Počet volených poslancov|Volebná miestnosť)",
    },
    "ba_podunajskebiskupice": {
        "mc": "Bratislava-Podunajské Biskupice", "mcnorm": "podunajskebiskupice", "expected": 16, "header": r"^(\d{2})\s+(?=\S)", "col_split": True, "per_line": True,
        "stop": r"^V Bratislave|^Ing\. |^starosta|^Rozhodnutie č\.", "skip": r"^(?:VOLEBNÝ OBVOD|okrsok|číslo|zahrňujúci|bývajúcich|sídlo|na hlasovanie|členov|komisie)",
    },
    "ba_lamac": {
        "mc": "Bratislava-Lamač", "mcnorm": "lamac", "expected": 6, "header": r"^VOLEBNÝ OKRSOK č\.\s*(\d+)\s*:", "streets_after": r"^Ulic[ea]\s*:", "per_line": True, "two_up_at": 50,
        "stop": r"^V Bratislave|^Ing\. |^starosta|^Volebné miestnosti sa nachádzajú",
    },
    "ba_rusovce": {
        "mc": "Bratislava-Rusovce", "mcnorm": "rusovce", "expected": 4, "header": r"^Okrsok č\.\s*(\d+)\s*$", "streets_after": r"^Prislúchajúce ulice\s*:",
        "stop": r"^V Bratislave|^Ing\. |^starosta|^Bratislava-Rusovce\s+\d",
    },
    "ba_cunovo": {"mc": "Bratislava-Čunovo", "mcnorm": "cunovo", "expected": 2, "header": r"^Volebný okrsok č\.\s*(\d+)\s*:", "streets_after": r"^Prislúchajúce ulice\s*:", "stop": r"^V Bratislave|^Ing\. |^starostka|^JUDr\."},
    "ba_jarovce": {"mc": "Bratislava-Jarovce", "mcnorm": "jarovce", "expected": 3, "header": r"^Volebný okrsok č\.\s*(\d+)\s*:", "streets_after": r"^Prislúchajúce ulice\s*:", "stop": r"^V Bratislave|^Ing\. |^starosta"},
    "ba_karlovaves": {
        "mc": "Bratislava-Karlova Ves", "mcnorm": "karlovaves", "expected": 30, "header": r"^Volebný okrsok\s+(\d+)\s*$", "streets_after": r"^Ulica\s+Orientačné", "per_line": True, "continued": r"^\d",
        "stop": r"^V Bratislave|^Dana Čahojová|^starostka", "skip": r"^(?:Volebná miestnosť|Rozhodnutie|Podľa § 8|Vec\b|Do volebného obvodu|\d{1,3}$)",
    },
    "ba_devinskanovaves": {
        "mc": "Bratislava-Devínska Nová Ves", "mcnorm": "devinskanovaves", "expected": 15, "header": r"^(\d{1,2})\s+\D.*$", "per_line": True, "continued": r"^(?:\d|súp\.)",
        "stop": r"^V Bratislave|^Dárius Krajčír|^starosta", "skip": r"^(?:Obvod č\.|Komunálne voľby|Dátum\b|\d{1,3}$)",
    },
}

#: Area, precincts, x-ranges and line patterns of the documents that are tables.
TABLES: dict[str, dict[str, Any]] = {
    "ke_stare_mesto": {
        "mc": "Košice-Staré Mesto", "mcnorm": "stare mesto", "expected": 19, "halves": [{"okr": (50, 100), "street": (100, 218)}, {"okr": (303, 350), "street": (350, 448)}],
        "mode": "text", "per_line": True, "table_start": r"Číslo okrsku", "skip": r"^(?:Číslo|Územie|Sídlo|INFORMÁCIA|Mestská časť|Voľby do|Miestom konania)",
    },
    "ke_sidlisko_kvp": {
        "mc": "Košice-Sídlisko KVP", "mcnorm": "sidlisko kvp", "expected": 18, "halves": [{"okr": (60, 130), "street": (130, 240), "num": (240, 395)}], "mode": "split",
        "table_start": r"patriace do volebného", "skip": r"^(?:Číslo|Územie|Volebná|Volebný obvod|patriace|volebného|okrsku|\(sídlo)", "drop_footer": True,
    },
    "ke_dargovskych_hrdinov": {
        "mc": "Košice-Dargovských hrdinov", "mcnorm": "dargovskych hrdinov", "expected": 20, "halves": [{"okr": (110, 165), "street": (265, 380), "num": (380, 700)}], "mode": "split",
        "anchor_at": "top", "table_start": r"^Volebný obvod\s+Volebný", "skip": r"^(?:Volebný|Mestská časť|OZNÁMENIE|Adresa|Ulica|Číslo|Starosta)", "drop_footer": True,
    },
    "ke_juh": {
        "mc": "Košice-Juh", "mcnorm": "juh", "expected": 18, "halves": [{"okr": (50, 100), "street": (125, 620)}], "mode": "text", "table_start": r"Územie patriace do volebného",
        "skip": r"^(?:Volebný obvod|Číslo|Územie|Volebná|STAROSTKA|V súlade|okrsku|na sobotu|určuje|volebné okrsky)",
    },
    "ke_sidlisko_tahanovce": {
        "mc": "Košice-Sídlisko Ťahanovce", "mcnorm": "sidlisko tahanovce", "expected": 18, "headers": {"okr": r"Okrsok", "street": r"N[áa]zov", "num": r"Orienta"}, "mode": "split", "loose": "register",
    },
    "ke_sever": {
        "mc": "Košice-Sever", "mcnorm": "sever", "expected": 18, "halves": [{"okr": (60, 105), "street": (105, 600)}], "mode": "text", "anchor_at": "top",
        "skip": r"^(?:VOLEBNÝ|ÚZEMIE|VOLEBNÁ|OZNÁMENIE|Starosta|určuje|volebné okrsky|pre voľby|ktoré sa|dňa |V Košiciach|Košice,|Ing\.|Mgr\.|\d{1,2}\.\d{1,2}\.\d{4})",
    },
    "ke_nad_jazerom": {
        "mc": "Košice-Nad jazerom", "mcnorm": "nad jazerom", "expected": 20, "halves": [{"okr": (60, 270), "street": (270, 700)}], "mode": "text", "per_line": True, "anchor_at": "top",
        "table_start": r"Územný obvod", "skip": r"^(?:Číslo|Územný|MESTSKÁ|Miestny|Oddelenie|Vytvorenie|V súlade|a určenie|okrsky a|Poznámka|V Košiciach|Ing\.|Mgr\.|starostka|- Nad jazerom)",
    },
    "ba_petrzalka": {
        "mc": "Bratislava-Petržalka", "mcnorm": "petrzalka", "expected": 96, "halves": [{"okr": (30, 80), "street": (218, 335), "num": (335, 900)}], "mode": "split", "anchor_at": "top",
        "skip": r"^(?:Volebný obvod|Okrsok|Ulica|Čísla|Zoznam volebných|pre voľby|starosta|Ing\. |BRATISLAVA\b|PETRŽALKA\s*$)",
    },
    "ba_dubravka": {
        "mc": "Bratislava-Dúbravka", "mcnorm": "dubravka", "expected": 31, "halves": [{"okr": (135, 200), "street": (230, 560)}], "mode": "text", "per_line": True,
        "table_start": r"Volebné okrsky a volebné miestnosti v mestskej časti",
        "skip": r"^(?:Volebná miestnosť|Volebný|okrsok|číslo|Z[ŠS] |KC |SP[ŠS]|Gymnázium|Základná|Volebné okrsky|Dúbravka pre|samosprávnych krajov|mestskej časti|krajov,|ktoré sa|voľby do orgánov)",
    },
}

_PATTERNS = ("header", "streets_after", "stop", "skip", "start_after", "end_section", "continued", "table_start")


def settings(source: dict[str, Any]) -> dict[str, Any]:
    """What the engine takes of a source's settings; patterns ignore case."""
    any_case = lambda k, v: {n: f"(?iu){p}" for n, p in v.items()} if k == "headers" else f"(?iu){v}" if k in _PATTERNS else v
    return {k: any_case(k, v) for k, v in source.items() if k not in ("mc", "mcnorm", "expected")}


def _named(rules: DataFrame, source: dict[str, Any]) -> DataFrame:
    return rules.withColumns({"mc": F.lit(source["mc"]), "mcnorm": F.lit(source["mcnorm"])})


def section_rules(lines: DataFrame, name: str) -> DataFrame:
    """Rules of a source's documents; lines: doc, line_no, text."""
    return _named(documents.sections(lines, **settings(SECTIONS[name])), SECTIONS[name])


def table_rules(words: DataFrame, name: str) -> DataFrame:
    """Rules of a source's documents; words: doc, page, x, y, text."""
    return _named(documents.table_rules(words, **settings(TABLES[name])), TABLES[name])


def expected(spark) -> DataFrame:
    """source, mcnorm, expected."""
    rows = [(name, s["mcnorm"], s["expected"]) for name, s in (SECTIONS | TABLES).items()]
    return spark.createDataFrame(rows, "source string, mcnorm string, expected int")


def count_check(rules: DataFrame, wanted: DataFrame) -> DataFrame:
    """mcnorm, rules, okrsky, expected and flag (missing, short, over or ok; unknown where no number is expected), with a row of totals."""
    counts = rules.groupBy("mcnorm").agg(F.count("*").alias("rules"), F.count_distinct("okrsok").alias("okrsky"))
    both = wanted.join(counts, "mcnorm", "left").select("mcnorm", F.coalesce("rules", F.lit(0)).alias("rules"), F.coalesce("okrsky", F.lit(0)).alias("okrsky"), "expected")
    flag = F.when(F.col("rules") == 0, "missing").when(F.col("expected") == 0, "unknown").when(F.col("okrsky") < F.col("expected"), "short").when(F.col("okrsky") > F.col("expected"), "over").otherwise("ok")
    total = both.agg(F.lit("total").alias("mcnorm"), F.sum("rules").alias("rules"), F.sum("okrsky").alias("okrsky"), F.sum("expected").alias("expected"))
    return both.withColumn("flag", flag).unionByName(total.withColumn("flag", F.lit("total")))
