"""Landed documents derived row by row from the test tables."""

from pyspark.sql import functions as F

from rinkflow.plans.catalog.standins import once, table
from rinkflow.session import scratch_folder


#: Documents of a file: compressed files are read whole, so that they have to stay small.
DOCUMENTS_PER_FILE = 1 << 16

#: Writer options for a document per lineitem row: plain ones take 17 times the disk of the table.
#: Spark gives a task at most 28 files, as if each had 4 MB more; with larger files few tasks would parse all.
#: The usual level (six) takes a fifth less disk, but twice the time to compress.
SMALL = {"compression": "gzip", "zlib.compress.level": "THREE", "maxRecordsPerFile": 1 << 14}


def write_text_documents(df, path, **options):
    df.write.options(**options).text(path)
    return path


def _landing(df):
    """A writer of compressed documents, added to those that are there."""
    return df.write.mode("append").option("compression", "snappy").option("maxRecordsPerFile", DOCUMENTS_PER_FILE)


def event_pages(spark, folder):
    """Three events per order; every other page wraps its list in an object."""
    key = F.col("o_orderkey")

    def ref(i):
        number = key * 3 + i
        label = F.when(number % 17 == 0, "").when(number % 19 != 0, F.concat(F.lit("E"), number.cast("string")))
        return F.struct(label.alias("isuId"))

    events = F.array(ref(0), ref(1), ref(2))
    page = F.when(key % 2 == 0, F.to_json(events)).otherwise(F.to_json(F.struct(events.alias("results"))))
    return table(spark, folder, "orders").select(page.alias("value"))


def event_details(spark, folder):
    """A customer as an event; some have damaged names, some no track."""
    key = F.col("c_custkey")
    name = F.when(key % 5 == 0, F.concat(F.lit("TromsÃ¸ "), F.col("c_name"))).otherwise(F.col("c_name"))
    track = F.struct(
        F.concat(F.lit("Rink "), F.col("c_mktsegment")).alias("name"),
        F.col("c_mktsegment").alias("city"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"),
        F.col("c_acctbal").alias("latitude"),
        F.col("c_nationkey").cast("double").alias("longitude"),
    )
    return table(spark, folder, "customer").select(
        F.concat(F.lit("E"), key.cast("string")).alias("event_id"),
        name.alias("name"),
        F.when(key % 7 != 0, track).alias("track"),
    )


def competitions(spark, folder):
    """Two competitions per part, the second often without a title."""
    key = F.col("p_partkey")
    first = F.struct((key + 1).cast("int").alias("scheduleNumber"), F.col("p_name").alias("title"))
    second = F.struct(
        (key % 3).cast("int").alias("scheduleNumber"),
        F.when(key % 2 == 0, F.col("p_brand")).alias("title"),
    )
    return table(spark, folder, "part").select(
        F.concat(F.lit("E"), key.cast("string")).alias("event_id"),
        F.array(first, second).alias("competitions"),
    )


def competition_details(spark, folder):
    """A lineitem row as a race with two measured conditions."""
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    start = F.struct(
        F.concat(day, F.lit("T10:11:12Z")).alias("timeStamp"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_quantity")).alias("airTemperature"),
        (-F.col("l_tax")).alias("iceTemperature"),
        F.col("l_discount").alias("humidity"),
        F.lit("start").alias("occasion"),
    )
    end = F.struct(
        F.date_format("l_shipdate", "dd-MM-yyyy").alias("timeStamp"),
        (F.col("l_quantity") + 1.0).alias("airTemperature"),
        (-F.col("l_tax")).alias("iceTemperature"),
        F.col("l_discount").alias("humidity"),
        F.lit("end").alias("occasion"),
    )
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("E"), F.col("l_orderkey").cast("string")).alias("event_id"),
        F.col("l_partkey").cast("int").alias("schedule_number"),
        F.struct(F.col("l_linenumber").alias("distance")).alias("distance"),
        F.array(start, end).alias("conditions"),
    )


def competition_results(spark, folder):
    """A lineitem row as a race: a list of two results, or one object."""

    def result(rank, first):
        skater = F.struct(
            F.lit(first).alias("firstName"), F.lit("van Dam").alias("lastName"),
            F.col("l_linestatus").alias("country"),
            F.when(F.col("l_returnflag") == "A", "F").otherwise("M").alias("gender"),
        )
        competitor = F.struct(F.col("l_suppkey").cast("string").alias("number"), skater.alias("skater"))
        return F.struct(
            F.lit(rank).alias("rank"),
            F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(",5")).alias("time"),
            F.col("l_linenumber").alias("startNumber"),
            F.when(F.col("l_partkey") % 2 == 0, "I").alias("startLane"),
            competitor.alias("competitor"),
        )

    both = F.array(result(1, "Ann Lee"), result(2, "JÃ¶rg"))
    documents = F.when(F.col("l_partkey") % 3 == 0, F.to_json(result(1, "Ann Lee"))).otherwise(F.to_json(both))
    head = F.concat(
        F.lit('{"event_id":"E'), F.col("l_orderkey").cast("string"),
        F.lit('","schedule_number":'), F.col("l_partkey").cast("string"), F.lit(',"results":'),
    )
    return table(spark, folder, "lineitem").select(F.concat(head, documents, F.lit("}")).alias("value"))


def season_bests(spark, folder):
    """A customer's seasons: two with records, one without."""
    key = F.col("c_custkey")

    def record(distance, seconds):
        return F.struct(
            F.lit(distance).alias("distance"),
            F.concat((key % 50 + seconds).cast("string"), F.lit(",25")).alias("time"),
        )

    def season(start, *records):
        rows = F.array(*records) if records else F.lit(None).cast("array<struct<distance:int,time:string>>")
        return F.struct(start.cast("int").alias("start"), rows.alias("records"))

    year = F.lit(1995) + key % 4
    return table(spark, folder, "customer").select(
        key.cast("string").alias("skater_id"),
        F.array(
            season(year, record(500, 36), record(1000, 75), record(500, 37)),
            season(year, record(1500, 110)),
            season(year + 1),
        ).alias("seasons"),
    )


def skaters(spark, folder):
    """Two skaters per part and country."""
    given = F.split_part("p_name", F.lit(" "), F.lit(1))
    family = F.split_part("p_name", F.lit(" "), F.lit(2))
    key = F.col("p_partkey")

    def skater(number, first):
        return F.struct(number.cast("string").alias("id"), first.alias("givenname"), family.alias("familyname"))

    return table(spark, folder, "part").select(
        F.concat(F.lit("P"), (key % 3).cast("string")).alias("country"),
        F.array(skater(key * 2, given), skater(key * 2 + 1, F.concat(given, F.lit("e")))).alias("skaters"),
    )


def weather(spark, folder):
    """A day of hourly weather per customer."""
    key = F.col("c_custkey")
    hours = F.sequence(F.lit(0), F.lit(23))
    hourly = F.struct(
        F.transform(hours, lambda h: F.format_string("2024-01-05T%02d:00", h)).alias("time"),
        F.transform(hours, lambda h: h - F.col("c_nationkey").cast("double")).alias("temperature_2m"),
        F.transform(hours, lambda h: F.when((h + key) % 5 != 0, h + 1000.0)).alias("surface_pressure"),
        F.transform(hours, lambda h: h + 1010.0).alias("pressure_msl"),
    )
    return table(spark, folder, "customer").select(
        F.col("c_acctbal").alias("latitude"), key.cast("double").alias("longitude"), hourly.alias("hourly")
    )


# --- a whole landing folder: customers are events and skaters, orders are races


def _races(spark, folder):
    customers = table(spark, folder, "customer")
    orders = table(spark, folder, "orders")
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"])


def _event_id(key):
    return F.concat(F.lit("E"), F.col(key).cast("string")).alias("event_id")


def _family(key):
    """Customer number in letters, as part of a family name."""
    return F.concat(F.lit("Van "), F.translate(F.col(key).cast("string"), "0123456789", "abcdefghij"))


def _land_country(key):
    return F.concat(F.lit("n"), (F.col(key) % 5).cast("string"))


def race_competitions(spark, folder):
    """One individual race per order, a team race and one without a number."""
    key = F.col("o_orderkey")
    distances = F.array(*[F.lit(d) for d in (500, 1000, 1500, 3000, 5000, 10000)])
    title = F.concat(
        F.get(distances, (key % 6).cast("int")).cast("string"), F.lit("m "),
        F.when(key % 2 == 0, "Men").otherwise("Women"),
    )
    entry = lambda number, text: F.struct(
        number.cast("int").alias("scheduleNumber"), text.alias("title")
    )
    return table(spark, folder, "orders").select(
        _event_id("o_custkey"),
        F.array(
            entry(key + 1, F.when(key % 23 != 0, title)),
            entry(key + 1, F.lit("TEAM Pursuit")),
            entry(F.lit(0), title),
        ).alias("competitions"),
    )


def race_details(spark, folder):
    """Start and end measurement per order; the end often lacks its humidity."""
    key = F.col("o_orderkey")
    stamp = lambda day, clock: F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(clock))
    measured = lambda at, extra, humidity, occasion: F.struct(
        at.alias("timeStamp"),
        (F.col("o_totalprice") + extra).alias("airTemperature"),
        F.lit(-5.5).alias("iceTemperature"),
        humidity.alias("humidity"),
        F.lit(occasion).alias("occasion"),
    )
    later = F.date_add(F.col("o_orderdate").cast("date"), (key % 3).cast("int"))
    both = F.array(
        measured(stamp("o_orderdate", "T10:11:12Z"), 0.0, F.lit(40.0), "start"),
        measured(stamp(later, "T11:30:00"), 1.0, F.when(key % 2 == 1, 41.0), "end"),
    )
    return table(spark, folder, "orders").select(
        _event_id("o_custkey"), (key + 1).cast("int").alias("schedule_number"),
        F.struct((key % 6).cast("int").alias("distance")).alias("distance"),
        F.when(key % 13 != 0, both).otherwise(F.slice(both, 1, 0)).alias("conditions"),
    )


def race_results(spark, folder):
    """The customer, and mostly an unknown second skater, per order."""
    key = F.col("o_orderkey")

    def result(pair, first, last, time):
        skater = F.struct(
            F.lit(first).alias("firstName"), last.alias("lastName"),
            _land_country("o_custkey").alias("country"), F.lit("F").alias("gender"),
        )
        return F.struct(
            F.lit(pair).alias("rank"), time.alias("time"), F.lit(pair).alias("startNumber"),
            F.struct(F.lit(str(pair)).alias("number"), skater.alias("skater")).alias("competitor"),
        )

    time = F.concat((key % 60 + 30).cast("string"), F.lit(",5"))
    one = result(1, "Anna", _family("o_custkey"), time)
    two = result(2, "Zed", F.lit("Nobody"), F.when(key % 4 != 0, time).otherwise(""))
    document = F.when(key % 3 == 0, F.to_json(one)).otherwise(F.to_json(F.array(one, two)))
    head = F.format_string('{"event_id":"E%d","schedule_number":%d,"results":', F.col("o_custkey"), key + 1)
    return table(spark, folder, "orders").select(F.concat(head, document, F.lit("}")).alias("value"))


def race_skaters(spark, folder):
    skater = F.struct(
        F.col("c_custkey").cast("string").alias("id"), F.lit("Anna").alias("givenname"),
        _family("c_custkey").alias("familyname"),
    )
    return table(spark, folder, "customer").select(
        _land_country("c_custkey").alias("country"), F.array(skater).alias("skaters")
    )


def race_weather(spark, folder):
    """Two hours at the rink of each order's day."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    pair = lambda value: F.array(value, value + 1.0)
    hourly = F.struct(
        F.array(F.concat(day, F.lit("T10:00")), F.concat(day, F.lit("T11:00"))).alias("time"),
        pair(F.dayofmonth("o_orderdate").cast("double")).alias("temperature_2m"),
        pair(F.col("c_nationkey") + 1000.0).alias("surface_pressure"),
        pair(F.lit(1010.0)).alias("pressure_msl"),
    )
    return _races(spark, folder).select(
        F.col("c_acctbal").alias("latitude"), F.col("c_nationkey").cast("double").alias("longitude"),
        hourly.alias("hourly"),
    )


def _stale(spark, folder, path):
    """Earlier versions of some documents: other events, titles, measures and times."""
    details = race_details(spark, folder).where("schedule_number % 3 = 0")
    details = details.withColumn("conditions", F.transform("conditions", lambda c: c.withField("airTemperature", F.lit(99.0))))
    _landing(details).json(f"{path}/competition_details")
    results = race_results(spark, folder).where(F.crc32("value") % 4 == 0)
    _landing(results.withColumn("value", F.regexp_replace("value", ",5\"", ",9\""))).text(f"{path}/competition_results")
    listed = race_competitions(spark, folder).withColumn(
        "competitions", F.transform("competitions", lambda c: c.withField("title", F.lit("500m Old")))
    )
    _landing(listed).json(f"{path}/competitions")
    _landing(event_details(spark, folder).withColumn("name", F.lit("Old"))).json(f"{path}/event_details")


def landing_folder(spark, folder, path, again=False):
    """Write all document kinds under ``path``, after earlier versions of some; ``again``: once more as they are."""
    if not again:
        _stale(spark, folder, path)
    pages = table(spark, folder, "customer").select(
        F.to_json(F.array(F.struct(_event_id("c_custkey").alias("isuId")))).alias("value")
    )
    # Some events are listed twice.
    pages = pages.union(pages.where(F.crc32("value") % 3 == 0))
    _landing(pages).text(f"{path}/event_pages")
    _landing(race_results(spark, folder)).text(f"{path}/competition_results")
    for name, documents in (
        ("event_details", event_details), ("competitions", race_competitions),
        ("competition_details", race_details), ("skaters", race_skaters),
        ("season_bests", season_bests), ("weather", race_weather),
    ):
        _landing(documents(spark, folder)).json(f"{path}/{name}")
    return path


def landed_races(spark, folder):
    """The path of a whole landing folder."""
    return once(spark, folder, "races", lambda: landing_folder(spark, folder, scratch_folder(spark)))


def landed_results(spark, folder):
    """The path of the results documents."""
    return once(
        spark, folder, "results",
        lambda: write_text_documents(competition_results(spark, folder), scratch_folder(spark), **SMALL),
    )


def loose_results(spark, folder):
    """Results of an order with numbers as text, decimals or not at all; some are cut short, some lack a key."""
    key = F.col("o_orderkey")
    text = F.format_string(
        '{"event_id":%s,"schedule_number":"%d","results":[{"rank":%s,"time":"36,5","startNumber":"%d",'
        '"competitor":{"number":%d,"skater":{"firstName":"A","lastName":"B"}}}]}',
        F.when(key % 11 == 0, "null").otherwise(F.format_string('"E%d"', key)), key,
        F.when(key % 3 == 0, F.format_string('"%d"', key % 50)).when(key % 3 == 1, F.format_string("%d.0", key % 50)).otherwise('"DNF"'),
        key % 9, key,
    )
    cut = F.when(key % 7 == 0, F.expr("substring(value, 1, length(value) - 9)")).otherwise(F.col("value"))
    return table(spark, folder, "orders").withColumn("value", text).select(cut.alias("value"))
