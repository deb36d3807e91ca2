"""Adapters from the driver's tables to the engine's inputs.

No instrument files are supplied, so each table plays a role:

* ``documents`` rows are instrument files; ``labels`` adds keys for some of
  them, so keys really go missing.
* ``events`` rows are job status events (user = job, ts = time).
* ``orders`` are ingest requests, ``customer`` rows are API clients.
* ``embeddings`` vectors and ``lineitem`` quantities are image frames.

Every adapter is a lazy DataFrame derived from the tables, so the work of a
query grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcat.sources.tables import read_table

# Fixed values of the adapters (the DuckDB oracles spell the same rules).
DOC_KEYS = ["/doc/lang", "/doc/source", "/doc/n_chars", "/doc/text",
            "/labels/quality", "/labels/toxic"]
# Requested by the field queries: one duplicate and one key no file has.
REQUESTED_KEYS = ["/doc/lang", "/doc/source", "/doc/n_chars", "/labels/quality",
                  "/labels/toxic", "/labels/toxic", "/doc/title"]
BEAMLINE_RENAMES = {"src8": "bl832", "src0": ""}
REGISTERED_SPECS = [f"src{i}" for i in range(18)]
EVENT_STATUS = {"signup": "submitted", "view": "running", "click": "complete_with_issues",
                "purchase": "successful", "error": "error"}


def doc_file_path(source="source", lang="lang", doc_id="doc_id"):
    return F.concat(F.lit("/data/"), F.col(source), F.lit("/"), F.col(lang),
                    F.lit("/doc_"), F.col(doc_id).cast("string"), F.lit(".h5"))


def documents_with_labels(spark: SparkSession, sf_dir: str, *doc_columns: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", *doc_columns)
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id", "left")


def instrument_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the catalogue metadata an instrument file would carry."""
    return instrument_metadata_from(documents_with_labels(spark, sf_dir, "text", "lang", "source", "n_chars"))


def instrument_metadata_from(d: DataFrame) -> DataFrame:
    """``d``: doc_id, text, lang, source, n_chars and (optional) quality, toxic."""
    if "quality" not in d.columns:
        d = d.withColumn("quality", F.lit(None).cast("int")).withColumn("toxic", F.lit(None).cast("int"))
    beamline = F.col("source")
    for src, name in reversed(list(BEAMLINE_RENAMES.items())):
        beamline = F.when(F.col("source") == src, F.lit(name)).otherwise(beamline)
    proposal = (F.when(F.col("quality").isNull(), F.lit(None).cast("string"))
                .when(F.col("toxic") == 1, F.lit("None"))
                .when(F.col("quality") == 0, F.lit(""))
                .otherwise(F.concat(F.lit("P-"), F.col("doc_id").cast("string"))))
    return d.select(
        "doc_id",
        doc_file_path().alias("file_path"),
        F.col("n_chars").alias("size"),
        F.lit(None).cast("timestamp").alias("mod_time"),
        F.col("text").alias("file_name"),
        F.when(F.col("quality") == 1, F.concat(F.lit("pi-"), F.col("lang"))).alias("pi"),
        F.concat(F.col("lang"), F.lit("@"), F.col("source"), F.lit(".example")).alias("email"),
        F.col("source").alias("instrument_name"),
        proposal.alias("proposal"),
        beamline.alias("beamline"),
        F.col("lang").alias("username"),
        F.to_json(F.struct("n_chars", "quality", "toxic"),
                  {"ignoreNullFields": "false"}).alias("scientific_metadata"),
    )


def doc_fields(spark: SparkSession, sf_dir: str, keys: list[str] | None = None,
               with_doc_id: bool = False) -> DataFrame:
    """Long field table: one row per (file, key) that exists. With ``keys``
    only those keys are produced - like a file reader that opens only the
    requested datasets - so the scan reads only the columns they need."""
    want = set(keys) if keys is not None else set(DOC_KEYS)
    doc_cols = {"/doc/lang": "lang", "/doc/source": "source", "/doc/n_chars": "n_chars", "/doc/text": "text"}
    docs = read_table(spark, sf_dir, "documents", "doc_id", "lang", "source",
                      *sorted({c for k, c in doc_cols.items() if k in want} - {"lang", "source"}))
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    docs_path = docs.withColumn("file_path", doc_file_path())
    null_s = F.lit(None).cast("array<string>")
    null_i = F.lit(None).cast("array<bigint>")
    null_d = F.lit(None).cast("array<double>")
    scalar = F.array().cast("array<bigint>")
    one = F.array(F.lit(1).cast("bigint"))
    unlimited = F.array(F.lit(None).cast("bigint"))

    def row(key, kind, shape, maxshape, s=None, i=None, d=None):
        return F.struct(F.lit(key).alias("key"), F.lit(kind).alias("kind"),
                        shape.alias("shape"), maxshape.alias("maxshape"),
                        (s if s is not None else null_s).alias("str_values"),
                        (i if i is not None else null_i).alias("int_values"),
                        (d if d is not None else null_d).alias("dbl_values"))

    doc_rows = [r for k, r in [
        ("/doc/lang", lambda: row("/doc/lang", "S", scalar, scalar, s=F.array("lang"))),
        ("/doc/source", lambda: row("/doc/source", "S", one, one, s=F.array("source"))),
        ("/doc/n_chars", lambda: row("/doc/n_chars", "i", one, one, i=F.array("n_chars"))),
        ("/doc/text", lambda: row("/doc/text", "S", scalar, scalar, s=F.array("text"))),
    ] if k in want]
    label_rows = [r for k, r in [
        ("/labels/quality", lambda: row("/labels/quality", "i", one, unlimited,
                                        i=F.array(F.col("quality").cast("bigint")))),
        ("/labels/toxic", lambda: row("/labels/toxic", "i", scalar, scalar,
                                      i=F.array(F.col("toxic").cast("bigint")))),
    ] if k in want]
    parts = []
    if doc_rows:
        parts.append(docs_path.select("file_path", "doc_id", F.explode(F.array(*[r() for r in doc_rows])).alias("f")))
    if label_rows:
        parts.append(labels.join(docs_path.select("doc_id", "file_path"), "doc_id")
                     .select("file_path", "doc_id", F.explode(F.array(*[r() for r in label_rows])).alias("f")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("file_path", "doc_id", "f.*") if with_doc_id else out.select("file_path", "f.*")


def doc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File inventory of the document 'files'."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "lang", "source", "n_chars")
    return docs.select("doc_id", doc_file_path().alias("file_path"),
                       F.col("n_chars").alias("size"), F.col("source").alias("mapping_id"))


def event_status(col="event_type"):
    out = F.lit(None).cast("string")
    for et, st in reversed(list(EVENT_STATUS.items())):
        out = F.when(F.col(col) == et, F.lit(st)).otherwise(out)
    return out


def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> job_events(id, time, status, submitter, log, event_id)."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    return ev.select(
        F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("id"),
        F.col("ts").alias("time"),
        event_status().alias("status"),
        F.when(F.col("event_type") == "signup", F.concat(F.lit("user"), F.col("user_id").cast("string")))
         .otherwise(F.lit("system")).alias("submitter"),
        F.col("props").alias("log"),
        "event_id",
    )


# What an event does to the claim of its job.
EVENT_ACTION = {"signup": "submit", "view": "claim", "click": "renew", "purchase": "finish", "error": "finish"}


def claim_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (id, time, action, runner, event_id): three runners work on the users' jobs."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    action = F.create_map(*[F.lit(x) for kv in EVENT_ACTION.items() for x in kv])
    return ev.select(F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("id"), F.col("ts").alias("time"),
                     F.try_element_at(action, F.col("event_type")).alias("action"),
                     F.concat(F.lit("runner"), (F.col("event_id") % 3).cast("string")).alias("runner"), "event_id")


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API clients: customers in good standing (balance >= 0) hold the key
    'key-<custkey>'; the table stores its SHA-256 digest."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return c.where(F.col("c_acctbal") >= 0).select(
        F.sha2(F.concat(F.lit("key-"), F.col("c_custkey").cast("string")), 256).alias("key_digest"),
        F.col("c_name").alias("client"), F.col("c_mktsegment").alias("api"))


def job_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest requests: one per order, presenting its customer's key."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return o.select(
        F.concat(F.lit("req-"), F.col("o_orderkey").cast("string")).alias("id"),
        F.concat(F.lit("key-"), F.col("o_custkey").cast("string")).alias("api_key"),
        F.concat(F.lit("/data/orders/"), F.col("o_orderkey").cast("string"), F.lit(".h5")).alias("document_path"),
        F.col("o_orderpriority").alias("mapping_id"),
        F.col("o_orderdate").alias("submit_time"))


def order_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue records for orders: owner = the customer, access = the
    customer's nation and the order's status."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select(
        F.col("o_orderkey").alias("pid"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("ownerGroup"),
        F.array(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")),
                F.concat(F.lit("s"), F.col("o_orderstatus"))).alias("accessGroups"),
        F.col("c_nationkey").alias("proposal"))


def supplier_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    return s.select(F.col("s_name").alias("user"),
                    F.array(F.concat(F.lit("c"), F.col("s_suppkey").cast("string")),
                            F.concat(F.lit("n"), F.col("s_nationkey").cast("string"))).alias("groups"))


# Fixed value: the region whose nations have no share folder yet.
UNSHARED_REGION = "MIDDLE EAST"


def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    j = n.join(r, n.n_regionkey == r.r_regionkey).where(F.col("r_name") != UNSHARED_REGION)
    return j.select(F.col("n_nationkey").alias("proposal"),
                    F.concat(F.lit("/shares/"), F.lower("r_name"), F.lit("/"), F.lower("n_name")).alias("share_folder"))


def vec_path():
    return F.concat(F.lit("/data/vectors/vec_"), F.col("vec_id").cast("string"), F.lit(".h5"))


def vec_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as vector files: an index array (the time stamps), the
    vector, its positive components (a shorter array) and a scalar label."""
    e = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    n = F.array(F.size("embedding").cast("bigint"))
    scalar = F.array().cast("array<bigint>")
    null_s = F.lit(None).cast("array<string>")
    null_i = F.lit(None).cast("array<bigint>")
    null_d = F.lit(None).cast("array<double>")

    def row(key, kind, shape, i=None, d=None):
        return F.struct(F.lit(key).alias("key"), F.lit(kind).alias("kind"), shape.alias("shape"),
                        shape.alias("maxshape"), null_s.alias("str_values"),
                        (i if i is not None else null_i).alias("int_values"),
                        (d if d is not None else null_d).alias("dbl_values"))

    positive = F.filter("embedding", lambda x: x > 0)
    return e.select(vec_path().alias("file_path"), F.explode(F.array(
        row("/vec/index", "f", n, d=F.when(F.size("embedding") > 0, F.sequence(
            F.lit(0), F.size("embedding") - 1)).otherwise(F.array()).cast("array<double>")),
        row("/vec/embedding", "f", n, d=F.col("embedding").cast("array<double>")),
        row("/vec/positive", "f", F.array(F.size(positive).cast("bigint")),
            d=positive.cast("array<double>")),
        row("/vec/label", "i", scalar, i=F.array(F.col("label").cast("bigint"))),
    )).alias("f")).select("file_path", "f.*")


def vec_instrument_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as instrument files under the instrument's own keys: names, a detector setting,
    and arrays of sampled keys. Motor steps are the components in thousandths (absent for every
    fifth file), their positive part, and 32 turns of them; one key is a scalar, one is empty."""
    e = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    steps = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000).cast("bigint"))
    base = e.select("vec_id", vec_path().alias("file_path"), "label", steps.alias("steps"))
    scalar, one, none = F.array().cast("array<bigint>"), F.array(F.lit(1).cast("bigint")), F.lit(None)

    def row(key, kind, s=None, i=None, d=None, shape=None):
        values = s if s is not None else i if i is not None else d
        shape = F.array(F.size(values).cast("bigint")) if shape is None else shape
        return F.struct(F.lit(key).alias("key"), F.lit(kind).alias("kind"), shape.alias("shape"), shape.alias("maxshape"),
                        (none if s is None else s).cast("array<string>").alias("str_values"),
                        (none if i is None else i).cast("array<bigint>").alias("int_values"),
                        (none if d is None else d).cast("array<double>").alias("dbl_values"))

    name = F.concat(F.lit("vec "), F.col("vec_id").cast("string"))
    at, motors = "/measurement/instrument/", "/measurement/instrument/sample_motor_stack/setup/"
    axis = F.when(F.col("vec_id") % 5 != 0, row(motors + "axis1pos", "i", i=F.col("steps")))
    count = F.size("steps")
    index = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array())
    return base.select("file_path", F.explode(F.array_compact(F.array(
        row("/measurement/sample/file_name", "S", s=F.array(name), shape=scalar),
        row("/measurement/sample/experimenter/name", "S", s=F.array(F.concat(F.lit("user"), F.col("label").cast("string"))), shape=scalar),
        row(at + "instrument_name", "S", s=F.array(F.lit("vectors")), shape=one),
        row(at + "detector/binning_x", "i", i=F.array(F.col("label")), shape=scalar),
        axis,
        row(motors + "axis2pos", "i", i=F.filter("steps", lambda x: x > 0)),
        row(motors + "sample_x", "i", i=F.flatten(F.array_repeat("steps", 32))),
        row(at + "time_stamp", "f", d=index),
        row(at + "monochromator/energy", "f", d=F.array(F.col("label")), shape=scalar),
        row(at + "detector/exposure_time", "i", i=F.array(F.col("label")), shape=one),
        row(at + "monochromator/setup/turret1", "f", d=F.array()),
    ))).alias("f")).select("file_path", "f.*")


def vec_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding is a one-frame stack (8 x 8 pixels)."""
    e = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return e.select("vec_id", vec_path().alias("file_path"), F.lit(0).alias("frame_idx"),
                    F.lit(8).alias("height"), F.lit(8).alias("width"),
                    F.col("embedding").cast("array<double>").alias("pixels"))


def conversation_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as frame stacks: the turn is the frame index."""
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return c.select("conv_id", F.concat(F.lit("/data/conversations/conv_"), F.col("conv_id").cast("string"),
                                        F.lit(".h5")).alias("file_path"),
                    F.col("turn").alias("frame_idx"), "role", "text")


def quantity_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem quantities as 8-bit pixels; a frame is a (returnflag,
    linestatus) pair."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity",
                    "l_returnflag", "l_linestatus")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
                     F.col("l_quantity").cast("int").alias("v"))
