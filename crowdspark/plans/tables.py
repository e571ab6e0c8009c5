"""The given tables, and views that give them the schemas of the operators."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdspark.session import spread

# unique within a subject; the same order as (created_at, line_no, part_no, quantity)
ANNOTATION_ORDER = ("position",)


def text(column: str):
    return F.col(column).cast("string")


class Tables:
    """Lazy views over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{table}.parquet")

    @cached_property
    def inventory(self) -> DataFrame:
        """``events`` as images: one site per user, one roll per week."""
        rows = self.read("events").select(
            F.lit("EV").alias("season"),
            F.concat(F.lit("U"), text("user_id")).alias("site"),
            F.weekofyear("ts").cast("string").alias("roll"),
            F.concat(F.lit("IMG"), text("event_id"), F.lit(".JPG")).alias("image_name_original"),
            F.date_trunc("second", "ts").cast("timestamp_ntz").alias("datetime"),
            "event_id", "event_type", "value", "props",
        )
        folder = F.concat(F.col("site"), F.lit("/"), F.col("site"), F.lit("_R"), F.col("roll"), F.lit("/"),
                          F.col("image_name_original"))
        return rows.withColumns({
            "image_path_original": F.concat(F.lit("/img/EV/"), folder),
            "image_path_original_rel": F.concat(F.lit("EV/"), folder),
        })

    @cached_property
    def annotations(self) -> DataFrame:
        """``lineitem`` as annotations: one subject per order, one user per supplier."""
        pair = F.concat("l_returnflag", "l_linestatus")
        species = F.lit("buffalo")
        for code, label in (("RF", "human"), ("NO", "blank"), ("NF", "giraffe"), ("AO", "lion"), ("AF", "zebra")):
            species = F.when(pair == code, label).otherwise(species)
        count = (
            F.when(pair == "NO", "").when(F.col("l_quantity") > 40, "51+").when(F.col("l_quantity") > 10, "11-50")
            .otherwise(F.col("l_quantity").cast("int").cast("string"))
        )
        standing = (
            F.when((pair == "NO") | (F.col("l_tax") == 0), "").when(F.col("l_tax") >= 0.04, "1").otherwise("0")
        )
        young = F.when(pair == "NO", "").when(F.col("l_discount") >= 0.08, "1").otherwise("0")
        day = F.unix_date(F.to_date("l_shipdate")).cast("bigint")
        position = ((day * 16 + F.col("l_linenumber")) * F.lit(2**31) + F.col("l_partkey")) * 64 + F.col("l_quantity").cast("int")
        return self.read("lineitem").select(
            text("l_orderkey").alias("subject_id"),
            F.concat(F.lit("u"), text("l_suppkey")).alias("user_name"),
            F.concat_ws("-", text("l_orderkey"), text("l_suppkey")).alias("classification_id"),
            species.alias("question__species"), count.alias("question__count"),
            standing.alias("question__standing"), young.alias("question__young_present"),
            F.col("l_shipdate").alias("created_at"), F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("part_no"), F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").alias("quantity"), position.alias("position"),
        )

    @cached_property
    def classifications(self) -> DataFrame:
        """``lineitem`` as a classification export with JSON columns, one row per line item."""
        flags = F.concat("l_returnflag", "l_linestatus")
        quantity, part = F.col("l_quantity").cast("int"), F.col("l_partkey")
        how_many = F.when(quantity > 40, "51").when(quantity > 10, "1150").otherwise(quantity.cast("string"))
        doing = F.when(part % 2 == 0, '["MOVING","EATING"]').otherwise('["MOVING"]')
        young = F.when(F.col("l_tax") >= 0.04, "YES").otherwise("NO")
        lion = '{"choice":"LION","answers":{},"filters":{}}'
        zebra = F.concat(
            F.lit('{"choice":"ZEBRA","answers":{"HOWMANY":"'), how_many, F.lit('","WHATBEHAVIORSDOYOUSEE":'), doing,
            F.lit(',"ARETHEREANYYOUNGPRESENT":"'), young, F.lit('","DONTCARE":"X"},"filters":{"LIKE":"HORSE"}}'))
        giraffe = F.concat(F.lit('{"choice":"GIRAFFE","answers":{"HOWMANY":"'), how_many, F.lit('"}}'))

        def tasks(*values):
            parts = [F.concat(F.lit(f'{{"task":"T{n}","value":'), v if not isinstance(v, str) else F.lit(v), F.lit("}"))
                     for n, v in enumerate(values)]
            return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))

        annotations = (
            F.when(flags == "AF", tasks(F.concat(F.lit("["), zebra, F.lit(f",{lion}]"))))
            .when(flags == "AO", tasks(f'[{{"choice":"NOTHINGHERE","answers":{{}}}},{lion},{lion}]'))
            .when(flags == "NF", tasks('"NOANIMALSPRESENT"'))
            .when(flags == "NO", tasks("[]"))
            .when(flags == "RF", tasks('["GIRAFFE","YES"]'))
            .otherwise(tasks('"GIRAFFE"', F.concat(F.lit("["), giraffe, F.lit("]"))))
        )
        live = F.when(F.col("l_tax") == 0.01, "").otherwise(
            F.concat(F.lit('"live_project":'), F.when(F.col("l_tax") == 0, "false").otherwise("true"), F.lit(",")))
        seen = F.when(F.col("l_discount") == 0.1, "true").otherwise("false")
        season = F.when(part % 7 == 0, "").otherwise(
            F.concat(F.lit(',"#season":"S'), (part % 2).cast("string"), F.lit('"')))
        anonymous = F.col("l_suppkey") % 10 == 0
        return spread(self.read("lineitem")).select(
            F.concat_ws("-", text("l_orderkey"), text("l_linenumber"), text("l_partkey"), text("l_suppkey"),
                        quantity.cast("string")).alias("classification_id"),
            F.concat(F.when(anonymous, "not-logged-in-").otherwise("u"), text("l_suppkey")).alias("user_name"),
            F.when(anonymous, "").otherwise(text("l_suppkey")).alias("user_id"),
            F.when(F.col("l_linenumber") <= 5, "10").otherwise("11").alias("workflow_id"),
            F.concat((part % 50 + 300).cast("string"), F.when(F.col("l_linenumber") == 1, "").otherwise(
                F.concat(F.lit("."), text("l_linenumber")))).alias("workflow_version"),
            F.when(quantity == 1, F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
                F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss 'UTC'")).alias("created_at"),
            F.concat(F.lit('{"source":"api",'), live, F.lit('"subject_selection_state":{"retired":false,"already_seen":'),
                     seen, F.lit("}}")).alias("metadata"),
            annotations.alias("annotations"),
            F.concat(F.lit('{"'), text("l_orderkey"), F.lit('":{"retired":null'), season, F.lit("}}")).alias("subject_data"),
            text("l_orderkey").alias("subject_ids"),
            F.col("l_extendedprice").alias("price"),
        )

    @cached_property
    def subject_export(self) -> DataFrame:
        """``orders`` as a subject export; two orders share a subject, so that the last row has to win."""
        key, site = F.col("o_orderkey"), (F.col("o_custkey") % 50).cast("string")
        urls = [F.when(key % 3 >= i, F.format_string(f'"{i}":"https://img.example.org/%d_{i}.jpg"', key)) for i in range(3)]
        parts = [
            F.format_string('"#season":"S%d"', F.year("o_orderdate") - 1994),
            F.concat(F.lit('"#site":"C'), site, F.lit('"')),
            F.when(key % 4 != 0, F.format_string('"#roll":"%d"', F.col("o_custkey") % 3 + 1)),
            F.format_string('"#capture":"%d"', key),
            F.when(key % 5 != 0, F.format_string('"#capture_id":"OR#C%s#%d"', site, key)),
        ]
        return self.read("orders").select(
            F.floor(key / 2).cast("string").alias("subject_id"), "o_orderkey",
            F.concat(F.lit("{"), F.concat_ws(",", *urls), F.lit("}")).alias("locations"),
            F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("metadata"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("retired_at"),
            F.col("o_orderstatus").alias("retirement_reason"),
            F.lit("").alias("created_at"),
        )

    @cached_property
    def order_captures(self) -> DataFrame:
        """``orders`` as captures, one per order."""
        key = F.col("o_orderkey")
        return self.read("orders").select(
            F.format_string("OR#Q%d#1#%d", key % 7, key).alias("capture_id"), F.lit("OR").alias("season"),
            F.format_string("Q%d", key % 7).alias("site"), F.lit("1").alias("roll"),
            key.cast("string").alias("capture"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("capture_date_local"),
        )

    def with_capture(self, aggregated: DataFrame) -> DataFrame:
        """Give each subject the capture of the even order number, so that two subjects share one."""
        key = F.col("subject_id").cast("bigint")
        even = key - key % 2
        return aggregated.withColumn("capture_id", F.format_string("OR#Q%d#1#%d", even % 7, even))

    @cached_property
    def species_predictions(self) -> DataFrame:
        """``embeddings`` as species predictions; the first components are the scores."""
        return self._predictions().select("capture_id", F.struct(
            F.create_map(F.lit("species"), F.concat(F.lit("l"), text("label")), F.lit("eating"),
                         F.when(F.get("embedding", F.lit(0)) > 0, "1").otherwise("0")).alias("predictions_top"),
            F.create_map(F.lit("species"), score(0), F.lit("eating"), score(1)).alias("confidences_top"),
            F.create_map(F.lit("species"), F.create_map(F.lit("l0"), score(0), F.lit("l1"), score(1), F.lit("l2"), score(2)),
                         F.lit("eating"), F.create_map(F.lit("0"), score(3), F.lit("1"), score(4))).alias("aggregated_pred"),
        ).alias("prediction"))

    @cached_property
    def empty_predictions(self) -> DataFrame:
        """``embeddings`` as empty predictions of both label names, missing for every third capture."""
        none = F.create_map().cast("map<string,string>")
        is_even = F.col("vec_id") % 2 == 0
        top = F.when(is_even, none).otherwise(F.create_map(
            F.lit("is_blank"), F.when(F.get("embedding", F.lit(7)) > 0, "1").otherwise("0")))
        scores = F.when(is_even, F.create_map(F.lit("empty"), F.create_map(
            F.lit("empty"), score(5), F.lit("species"), score(6)))).otherwise(F.create_map(
                F.lit("is_blank"), F.create_map(F.lit("0"), score(7), F.lit("1"), score(8))))
        return self._predictions().where(F.col("vec_id") % 3 != 0).select("capture_id", F.struct(
            top.alias("predictions_top"), none.alias("confidences_top"), scores.alias("aggregated_pred")).alias("prediction"))

    def _predictions(self) -> DataFrame:
        return self.read("embeddings").withColumn("capture_id", F.format_string("EM#%d#1#%d", F.col("label"), F.col("vec_id")))

    @cached_property
    def documents_as_files(self) -> DataFrame:
        """``documents`` as files: path, size and content."""
        folder = F.concat(F.col("lang"), F.lit("/"), F.col("lang"), F.when(F.col("doc_id") % 10 == 0, "-").otherwise("_"),
                          F.when(F.col("doc_id") % 7 == 0, "r").otherwise("R"), F.replace("source", F.lit("src"), F.lit("")))
        name = F.concat(F.lit("IMG"), text("doc_id"), F.when(F.col("doc_id") % 11 == 0, ".png").otherwise(".JPG"))
        return self.read("documents").select(
            "doc_id", F.concat(F.lit("/root/DOC/"), folder, F.lit("/"), name).alias("path"),
            F.col("n_chars").alias("length"), F.encode("text", "utf-8").alias("content"))


def score(component: int):
    """A component as text, in thousandths."""
    return F.floor(F.abs(F.get("embedding", F.lit(component)).cast("double")) * 1000).cast("string")


def legacy_names(t: Tables) -> dict:
    """Season, site and roll of an order in the spelling of the legacy export."""
    key = F.col("key")
    number = (key % 9 + 1).cast("string")
    return {
        "season": F.when(key % 50 == 0, "tutorial").when(key % 3 == 0, F.concat(F.lit("S"), number)).otherwise(number),
        "site": F.format_string("B0%d", key % 5),
        "roll": F.when(key % 2 == 0, "1").otherwise("r1"),
    }


def legacy_image(number):
    return F.format_string("PICT%dX%04d.JPG", F.floor(number / 10000), number % 10000)


def legacy_export(t: Tables) -> DataFrame:
    """``lineitem`` as a legacy export; several rows may share a classification and a species."""
    key, line, quantity = F.col("key"), F.col("l_linenumber"), F.col("l_quantity").cast("int")
    first, second = legacy_image(key * 2), legacy_image(key * 2 + 1)
    names = (
        F.when(line == 1, "").when(line == 2, F.concat_ws(";", first, second, first, second)).when(line == 3, first)
        .when(line == 4, F.concat_ws(";", second, first)).otherwise(F.lit("NONE0001.JPG"))
    )
    pair = F.concat("l_returnflag", "l_linestatus")
    species = F.when(pair == "NO", "").when(pair == "NF", "nothing").when(pair == "AF", "zebra").otherwise("lion")
    count = F.when(species.isin("", "nothing"), "").when(quantity > 45, "51+").when(quantity > 38, "11-50").when(
        quantity > 36, "").otherwise((quantity % 9 + 1).cast("string"))
    moving = F.when(F.col("l_tax") == 0, "").when(F.col("l_tax") >= 0.04, "true").otherwise("false")
    return spread(t.read("lineitem")).withColumn("key", F.col("l_orderkey")).select(
        F.concat_ws("-", text("l_orderkey"), (F.col("l_suppkey") % 5).cast("string")).alias("classification_id"),
        F.concat(F.lit("u"), (F.col("l_suppkey") % 3).cast("string")).alias("user_name"),
        text("l_orderkey").alias("subject_id"), F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        F.lit("consensus").alias("retirement_reason"), *[v.alias(k) for k, v in legacy_names(t).items()],
        names.alias("filenames"), species.alias("species"), count.alias("count"), moving.alias("moving"),
        F.when(F.col("l_discount") >= 0.05, "true").otherwise("false").alias("eating"),
        *[F.lit("").alias(c) for c in ("standing", "resting", "interacting", "young_present")],
        line.alias("line_no"), F.col("l_partkey").alias("part_no"), F.col("l_extendedprice").alias("price"),
    )


def legacy_images(t: Tables) -> DataFrame:
    """``orders`` as the image table of the legacy seasons, two images of different captures per order."""
    rows = t.read("orders").where("o_orderkey % 50 <> 0").withColumn("key", F.col("o_orderkey")).select(
        "key", *[v.alias(k) for k, v in legacy_names(t).items()], "o_custkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("n"))
    return rows.select(
        "season", "site", "roll", (F.col("o_custkey") + F.col("n")).cast("string").alias("capture"),
        F.concat(F.lit("any/path/"), legacy_image(F.col("key") * 2 + F.col("n"))).alias("path"))


def legacy_subjects(t: Tables) -> DataFrame:
    """Known captures of every fourth order."""
    return t.read("orders").where(F.col("o_orderkey") % 4 == 0).select(
        text("o_orderkey").alias("subject_id"), F.format_string("SER_S9#X#1#%d", F.col("o_orderkey")).alias("capture_id"))


def training_source(t: Tables) -> DataFrame:
    """``lineitem`` as database rows of a training file."""
    number, part = F.col("l_suppkey"), F.col("l_partkey")
    name = F.when(part % 3 == 0, F.format_string("PICT%d.JPG", part)).when(
        part % 3 == 1, F.format_string("IMG_%d.JPG", part)).otherwise(
        F.format_string("S%d_A%d_R1_IMAG%d.JPG", F.col("l_linenumber"), number, part))
    return spread(t.read("lineitem")).select(
        F.col("l_linenumber").cast("string").alias("season"), F.format_string("A%d", number).alias("site"),
        F.lit("1").alias("roll"), (F.col("l_orderkey") % 100).cast("string").alias("capture"),
        F.concat(F.format_string("S%d/A%d/A%d_R1/", F.col("l_linenumber"), number, number), name).alias("path"),
        F.when(F.col("l_quantity") == 1, "unknown").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
        F.when(F.col("l_returnflag") == "N", "0").otherwise("1").alias("n_species"),
        F.when(F.col("l_returnflag") == "A", "Zebra").otherwise("LION").alias("species"),
        F.when(F.col("l_quantity") > 40, "51+").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("count"),
        F.when(F.col("l_tax") == 0, "none").otherwise((F.col("l_tax") * 10).cast("string")).alias("Standing"),
        "l_orderkey", part.alias("part_no"), F.col("l_extendedprice").alias("price"), F.col("l_shipdate").alias("shipped"))
