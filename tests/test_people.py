import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks.queries import SETTINGS, models
from custarc.operators.components import connected
from custarc.operators.identity import each_copy, weighted_usage
from custarc.operators.people import one_per_person, with_person
from custarc.plans import marts
from custarc.sinks.tables import cut_into
from test_scale import conf, plan  # noqa: F401

SF = "/root/testdata/sf0.001"
SCHEMA = ("user_id string, first_name string, last_name string, gender string, email string, country string, "
          "signup_date date, lead_source string, phone string, created_at timestamp_ntz")


@pytest.fixture
def cut(tmp_path):
    return cut_into(str(tmp_path))


def test_components(spark, cut):
    r = random.Random(7)
    links = [(f"n{r.randrange(60)}", f"n{r.randrange(60)}") for _ in range(45)] + [(f"c{k:03}", f"c{k + 1:03}") for k in range(70)]
    links += [("hub", f"x{k}") for k in range(40)] + [("z", "z")]
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {x.node: x.root for x in connected(spark.createDataFrame(links, "a string, b string"), cut).collect()}
    assert got == {x: find(x) for x in root if x != "z"}


def user(i, mail, name=None, created=None, **more):
    row = dict(user_id=i, first_name=name, last_name="", gender="Others", email=mail, country=None, signup_date=None,
               lead_source=None, phone=None, created_at=created)
    return tuple((row | more).values())


def test_fields_of_a_person(spark, cut):
    from datetime import date, datetime

    day = lambda n: datetime(2025, 1, n)
    rows = [
        user("u3", "a@x", "Old", day(1), gender="Male", signup_date=date(2025, 1, 3)),
        user("u1", "a@x", "New", day(5), country="FR"),
        user("u1", "b@x", "", day(7), signup_date=date(2025, 1, 2)),  # linked through the id
        user(None, "b@x", None, None, phone="5"),
        user("u9", None, "Alone", day(2)),
        user(None, None, "Nobody", None), user(None, None, "Nobody", None),
        user(None, "c@x", "Mail", None),
    ]
    people = one_per_person(spark.createDataFrame(rows, SCHEMA), cut)
    found = {r.person: r for r in people.users.collect()}
    assert len(found) == 4
    one = next(r for r in found.values() if r.user_id == "u3")
    assert (one.first_name, one.gender, one.email, one.country, one.phone, str(one.signup_date)) == ("New", "Male", "b@x", "FR", "5", "2025-01-02")
    assert one.created_at == day(1) and one.last_name == ""
    ids = {r.user_id: r.email for r in people.ids.collect()}
    assert ids == {"u3": "b@x", "u1": "b@x", "u9": None}
    assert {r.email: r.user_id for r in people.emails.collect()} == {"a@x": "u3", "b@x": "u3", "c@x": None}


def test_people_of_random_rows(spark, cut):
    r = random.Random(3)
    rows = [user(r.choice([None, f"u{r.randrange(40)}"]), r.choice([None, "hot@x", f"m{r.randrange(40)}"]), str(k)) for k in range(120)]
    found = with_person(spark.createDataFrame(rows, SCHEMA), cut).collect()
    assert len(found) == len(rows)
    person = {}
    for x in found:
        for value in (("id", x.user_id), ("email", x.email)):
            if value[1] is not None:
                assert person.setdefault(value, x.person) == x.person
    assert len({x.person for x in found if x.email == "hot@x"}) == 1
    assert Counter(x.person for x in found if x.user_id is None and x.email is None).most_common(1)[0][1] == 1


def test_facts_keep_the_number_of_source_rows(spark, tmp_path):
    """Reference users repeat facts of shared e-mails; people don't."""
    m = models(spark, SF)
    people = replace(m, settings=replace(SETTINGS, users="one_per_email"), cut=cut_into(str(tmp_path)))
    for fact, source in (("fact_support", "stg_support_ticket"), ("fact_product_usage", "stg_product_usage"),
                         ("dim_subscription", "int_subscription")):
        assert getattr(people, fact).count() == getattr(m, source).count()
    assert m.fact_transaction.count() > m.stg_transaction.count()
    assert people.dim_user.count() == people.dim_user.select("user_sk").distinct().count()
    known = people.fact_product_usage.join(people.dim_user, "user_sk").count()
    assert known == marts.known_users(people.fact_product_usage).count()


def test_a_shared_email_is_not_multiplied(spark, conf):  # noqa: F811
    """An e-mail of 1,000 users: an event is 1,000 weighted rows, which stand for a million, and the
    mart that reads them never writes the copies out."""
    conf(shuffle__partitions="4")
    users = spark.range(1000).select(
        F.concat(F.lit("u"), F.col("id")).alias("user_id"), F.lit("all@x").alias("email"), F.md5(F.col("id").cast("string")).alias("user_sk")
    )
    usage = spark.createDataFrame(
        [("e1", None, "all@x"), ("e2", "u5", None), ("e3", "u6", "all@x")], "event_id string, user_id string, user_email string"
    ).select(
        "*", F.lit("Feature A").alias("feature_name"), F.lit(20240105).alias("event_timestamp_id"),
        F.lit("s").alias("session_id"), F.lit(2).alias("session_duration"),
    )
    weighted = weighted_usage(usage, users)
    rows = {r.event_id: (r.n, r.copies) for r in weighted.groupBy("event_id").agg(F.count("*").alias("n"), F.sum("copies").alias("copies")).collect()}
    assert rows == {"e1": (1000, 1_000_000), "e2": (1000, 1000), "e3": (1000, 1_000_000)}
    mart = marts.mart_engagement(weighted, SETTINGS)
    found = mart.collect()
    assert len(found) == 1000 and all((r.total_events, r.distinct_sessions, r.sum_session_duration) == (2001, 1, 4002) for r in found)
    assert "Generate" not in plan(mart)
    assert each_copy(weighted.where("event_id = 'e2'")).count() == 1000


def test_marts_of_weighted_and_written_out_usage_agree(spark):
    m = models(spark, SF)
    for mart in (lambda usage: marts.mart_engagement(usage, SETTINGS), lambda usage: marts.mart_acquisition(m.dim_user, usage, SETTINGS)):
        a, b = mart(m.fact_product_usage), mart(m.fact_product_usage_weighted)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
