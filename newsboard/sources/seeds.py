"""Seed tables: channels, concepts and the rules that link types to concepts."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from newsboard.functions.time import moment
from newsboard.sources import schemas as S

# Concept names; the position, from 1, is the concept id.
CONCEPT_NAMES = (
    "Culture",
    "Economics",
    "Education and Academia",
    "Events",
    "Food and Beverage",
    "Government",
    "Legal",
    "Military",
    "Science",
    "Software",
    "Space",
    "Sports and Fitness",
    "Transportation",
)

# Entity types per concept id, in rule order.
RULE_TYPES = (
    (1, """
        TopicalConcept TelevisionShow TelevisionEpisode Fashion Album
        FashionDesigner
    """),
    (12, """
        AmericanFootballLeague AmericanFootballTeam AutoRacingLeague
        BaseballLeague BaseballTeam BasketballLeague BasketballTeam
        CricketTeam CollegeCoach CyclingTeam FormulaOneTeam GolfLeague
        HockeyTeam IceHockeyLeague Racecourse RugbyLeague SoccerClub
        SoccerLeague SoccerManager SoccerPlayer SoccerTournament SportsEvent
        SportsLeague SportsManager SportsTeam Stadium TennisLeague
        Tournament VideogamesLeague AmericanFootballPlayer BaseballPlayer
        BasketballPlayer GolfPlayer GridironFootballPlayer IceHockeyPlayer
        RugbyPlayer TennisPlayer Wrestler Athlete Cricketer Curler
        CyclingRace FormulaOneRacer GrandPrix Gymnast HorseRace NascarDriver
        Olympics SkiArea Swimmer
    """),
    (4, """
        Venue Theatre Event SocietalEvent Convention FilmFestival Festival
    """),
    (3, """
        University EducationalInstitution AcademicJournal AcademicConference
        School
    """),
    (8, """
        MilitaryPerson MilitaryStructure MilitaryUnit
    """),
    (11, """
        Astronaut Rocket SpaceMission SpaceStation Satellite
    """),
    (9, """
        Bacteria BiologicalDatabase Biomolecule Hospital Scientist
    """),
    (5, """
        Beverage Brewery Cheese Chef Food Restaurant
    """),
    (6, """
        Ambassador Congressman Governor GovernmentAgency Legislature Mayor
        PoliticalParty Politician President Senator
    """),
    (13, """
        Airline Aircraft Airport AutoRacingLeague Automobile BusCompany
        MeanOfTransportation PublicTransitSystem Rocket Ship
    """),
    (7, """
        LawFirm LegalCase Judge
    """),
    (2, """
        Economist Currency Money
    """),
    (10, """
        ProgrammingLanguage Software
    """),
)

# Thresholds of every rule (confidence, relevance, topic score).
RULE_THRESHOLDS = ("1", "0.2", "0.2")

# Channel name, description, target, target id.
CHANNEL_ROWS = (
    ("Pop Culture", "Slack culture channel", "slack", "#pop-culture"),
    ("Sports", "Slack sports", "slack", "#sports-channel"),
)


def _columns(ddl: str) -> list[tuple[str, str]]:
    return [tuple(part.split(None, 1)) for part in _split_columns(ddl)]


def _split_columns(ddl: str) -> list[str]:
    """Top-level columns of a DDL string (``decimal(5,3)`` holds a comma)."""
    merged, depth = [""], 0
    for ch in " ".join(ddl.split()):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            merged.append("")
        else:
            merged[-1] += ch
    return [m.strip() for m in merged]


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Cast to the columns of ``ddl``; columns the input lacks become NULL."""
    return df.select(
        *[
            (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in _columns(ddl)
        ]
    )


def _with_ids(df: DataFrame) -> DataFrame:
    # Seed files hold a few hundred rows at most: one partition keeps file
    # order, and the ids that follow it are consecutive.
    return df.coalesce(1).withColumn("id", F.monotonically_increasing_id() + 1)


def small_table(spark: SparkSession, names: str, rows: list[tuple]) -> DataFrame:
    """A few literal rows, made from Arrow so that Spark knows their size and
    may broadcast them; rows from a Python list have no size estimate."""
    return spark.createDataFrame(pa.table(dict(zip(names.split(), zip(*rows)))))


def stamped(tables: dict[str, DataFrame], now: datetime) -> dict[str, DataFrame]:
    """Tables with the defaults of their columns: rows without a creation or
    update time get ``now``."""
    at = moment(now)
    return {
        name: df.withColumns({c: F.coalesce(c, at) for c in ("created_at", "updated_at") if c in df.columns})
        for name, df in tables.items()
    }


def read_seeds(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Seed CSVs of a folder, with ids by file order."""
    read = lambda name: spark.read.option("header", True).csv(f"{path}/{name}.csv")
    return {
        "channels": conform(_with_ids(read("channels")), S.CHANNELS),
        "concepts": conform(_with_ids(read("concepts")), S.CONCEPTS),
        "concept_entity_rules": conform(_with_ids(read("concept_entity_rules")), S.RULES),
    }


def default_seeds(spark: SparkSession) -> dict[str, DataFrame]:
    """The built-in seed rows, as :func:`read_seeds` would return them."""
    pairs = [(c, t) for c, types in RULE_TYPES for t in types.split()]
    confidence, relevance, topic = RULE_THRESHOLDS
    return {
        "channels": conform(
            small_table(spark, "id name description target target_id", [(i, *row) for i, row in enumerate(CHANNEL_ROWS, 1)]),
            S.CHANNELS,
        ),
        "concepts": conform(small_table(spark, "id name", list(enumerate(CONCEPT_NAMES, 1))), S.CONCEPTS),
        "concept_entity_rules": conform(
            small_table(
                spark,
                "id concept_id entity_type entity_confidence_score_threshold"
                " entity_relevance_score_threshold topic_score_threshold",
                [(i, c, t, confidence, relevance, topic) for i, (c, t) in enumerate(pairs, 1)],
            ),
            S.RULES,
        ),
    }
