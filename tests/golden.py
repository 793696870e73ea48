"""Hand-made postings that hit every cleaning rule, and their gazetteer."""

import json

from vacancylens.schemas import GAZETTEER, POSTING

PLACE = {"country": {"code": "POL", "name": "Poland"}, "street": "", "postalCode": "", "url": "slug"}


def posting(id, **changes):
    base = {
        "id": id,
        "name": "Example Sp. z o.o.",
        "location": {
            "places": [{**PLACE, "city": c} for c in ("Warsaw", "Gdynia", "Białystok")],
            "fullyRemote": True,
            "covidTimeRemotely": False,
        },
        "posted": 1640995200123,
        "renewed": 1641081600456,
        "title": "Database Developer",
        "technology": "sql",
        "logo": {"original": "a.jpeg", "jobs_details": "b.jpeg"},
        "category": "backend",
        "seniority": ["Senior", "Mid"],
        "url": "sql-developer",
        "regions": ["pl"],
        "salary": {"from": 20000, "to": 25000, "type": "b2b", "currency": "PLN"},
        "flavors": ["it"],
        "topInSearch": False,
        "highlighted": False,
        "onlineInterviewAvailable": True,
        "referralBonus": None,
        "referralBonusCurrency": None,
    }
    return base | changes


def cities(*names, remote=False):
    places = [{**PLACE, "city": n} if n is not None else dict(PLACE) for n in names]
    return {"places": places, "fullyRemote": remote, "covidTimeRemotely": False}


def pay(low, high, kind="permanent", currency="PLN"):
    return {"from": low, "to": high, "type": kind, "currency": currency}


POSTINGS = [
    posting("MOCK"),
    posting("DUP", title="first", salary=pay(1, 3)),
    posting("DUP", title="second"),
    posting("EURFIRST", salary=pay(1, 2, currency="EUR")),
    posting("EURFIRST", salary=pay(1, 2)),
    posting("EUR", salary=pay(1, 2, currency="EUR")),
    posting("NOFROM", salary=pay(None, 9000)),
    posting("NOPAY", salary=pay(None, None)),
    posting("NOPLACE", location=cities()),
    posting("NOCITY", location=cities(None, "Warszawa")),
    posting("FOREIGN", location=cities("Berlin", " warsaw ", "Atlantis")),
    posting("NODE", technology="Node.js", category="businessAnalyst"),
    posting("REACT", technology="React", category="ux/ui", title="react"),
    posting("NET", technology=".NET", category="żAx"),
    posting("EMPTY", technology="", category="DevOPS", seniority=[]),
    posting("NAN", technology="nan", category="", seniority=["Expert"]),
    posting("NULL", technology=None, category=None, seniority=["Guru"]),
    posting("UPPER", salary=pay(1, 2, "B2B")),
]


def envelope(postings=None, source="nofluffjobs", obtained="2021-12-01 08:30:05", total=None):
    postings = POSTINGS if postings is None else postings
    return json.dumps(
        {
            "metadata": {"source_name": source, "obtained_datetime": obtained},
            "raw_data": {"postings": postings, "totalCount": len(postings) if total is None else total},
        }
    )


def payloads(spark, *texts):
    rows = [(t, None, f"file{i}") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "payload string, modified timestamp, path string")


def gazetteer(spark):
    rows = [
        ("Warsaw", "Warszawa", "Polska", 52.23, 21.01),
        ("Warszawa", "Warszawa", "Polska", 52.23, 21.01),
        ("Gdynia", "Gdynia", "Polska", 54.52, 18.53),
        ("Białystok", "Białystok", "Polska", 53.13, 23.16),
        ("Berlin", "Berlin", "Deutschland", 52.52, 13.40),
    ]
    return spark.createDataFrame(rows, GAZETTEER)


def raw(spark, rows=None):
    rows = POSTINGS if rows is None else rows
    text = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "pos int, j string")
    from pyspark.sql import functions as F

    return text.select("pos", F.from_json("j", POSTING).alias("p")).select("pos", "p.*")
