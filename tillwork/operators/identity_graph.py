"""Identity edges from orders and demographic feeds, and the customer_360 reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions import codes
from tillwork.functions.fields import identity_id_of, identity_metadata, identity_type_of, qualified_identity
from tillwork.operators.components import connected_components
from tillwork.operators.keyed import (
    first_per_key,
    merge_conditional,
    merge_delete,
    merge_insert_only,
    merge_partial_update,
    merge_upsert,
    without_matches,
)

POS_RELATED = "posRelated"
DEMOGRAPHIC_RELATED = "demographicRelated"
EDGE_KEY = ["source", "source_type", "target", "target_type"]


# ---- edges from orders --------------------------------------------------------------


def modified_identity_orders(diff: DataFrame) -> DataFrame:
    before, after = F.col("previous_record.identity_ids"), F.col("current_record.identity_ids")
    return diff.filter(~before.eqNullSafe(after))


def related_identities(diff: DataFrame, today: str) -> DataFrame:
    """Identity lists that stop being related (-1) and that become related (+1)."""

    def side(record: str, frequency: int) -> Column:
        return F.struct(
            F.lit(frequency).alias("frequency"),
            F.col(f"{record}.identity_ids").alias("identities"),
            F.coalesce(F.col(f"{record}.ord_date"), F.lit(today).cast("date")).alias("date"),
        )

    both = F.array(side("previous_record", -1), side("current_record", 1))
    return modified_identity_orders(diff).select(F.inline(both)).filter(F.size("identities") > 1)


def identity_edges(related: DataFrame) -> DataFrame:
    """Every pair of an order's identities, smaller id first, summed over the orders.

    The pairs are the result itself; they leave the row one by one and are summed before
    the shuffle.
    """
    members = F.array_sort(
        F.array_distinct(F.transform("identities", lambda i: F.struct(i["identity_id"].alias("id"), i["identity_type"].alias("type"))))
    )
    first = related.select("frequency", "date", members.alias("m")).select(
        "frequency", "date", "m", F.posexplode("m").alias("i", "a")
    )
    pairs = first.select("frequency", "date", "a", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("b"))
    return pairs.groupBy(
        F.col("a.id").alias("source"), F.col("a.type").alias("source_type"),
        F.col("b.id").alias("target"), F.col("b.type").alias("target_type"),
    ).agg(
        F.lit(POS_RELATED).alias("relationship"),
        F.sum("frequency").cast("int").alias("frequency"),
        F.min("date").alias("created_date"),
        F.max("date").alias("last_seen_date"),
        F.lit(True).alias("active_flag"),
    )


def identity_edges_merge(stored: DataFrame, edges: DataFrame) -> DataFrame:
    """Add frequencies; an edge whose frequency falls to zero is deleted."""
    total = F.col("frequency") + F.col("s_frequency")
    return merge_conditional(
        stored, edges, EDGE_KEY,
        update={
            "frequency": total,
            "created_date": F.least("created_date", "s_created_date"),
            "last_seen_date": F.greatest("last_seen_date", "s_last_seen_date"),
            "active_flag": F.col("active_flag") & F.col("s_active_flag"),
        },
        keep=total > 0,
    )


def identity_dedup(stored: DataFrame, diff: DataFrame) -> DataFrame:
    """Apply an identity diff to the final table: delete what is gone, then upsert."""
    key = ["identity_id", "type"]
    gone = diff.filter("current_record IS NULL AND previous_record IS NOT NULL").select(
        "previous_record.identity_id", "previous_record.type"
    ).distinct()
    fresh = diff.filter("current_record IS NOT NULL").select("current_record.*").select(*stored.columns)
    return merge_upsert(merge_delete(stored, gone, key), first_per_key(fresh, key, ["weight"]), key)


# ---- demographic feeds --------------------------------------------------------------


def latest_feed(df: DataFrame) -> DataFrame:
    """Rows of the newest feed date; a literal date, so partitions are pruned."""
    newest = df.agg(F.max("feed_date")).first()[0]
    if newest is None:
        raise ValueError("the table has no feed date")
    return df.filter(F.col("feed_date") == F.lit(newest))


def demographic_maids(idfa: DataFrame, aaid: DataFrame) -> DataFrame:
    """(person_id, native_maid, maid_type) of both platforms, without duplicates."""

    def tagged(df: DataFrame, kind: str) -> DataFrame:
        known = df.filter(F.col("native_maid").isNotNull()).select("person_id", "native_maid").distinct()
        return known.withColumn("maid_type", F.lit(kind))

    return tagged(idfa, codes.MAID_IDFA).unionByName(tagged(aaid, codes.MAID_AAID))


def demographic_emails(emails: DataFrame, lookup: DataFrame) -> DataFrame:
    """Feed e-mails (unsalted SHA-256) that our lookup knows, under our salted hash."""
    known = first_per_key(
        lookup.filter(F.col("identity_type") == codes.EMAIL).select("original_value", "hashed_value"), ["hashed_value"]
    )
    known = known.select(F.sha2("original_value", 256).alias("sha256_lower_email"), "original_value", "hashed_value")
    feed = emails.filter(F.col("sha256_lower_email").isNotNull()).select("person_id", "sha256_lower_email").distinct()
    return feed.join(known, "sha256_lower_email").select(
        "person_id",
        F.col("hashed_value").alias("hashed_email"),
        identity_metadata(F.lit(codes.EMAIL), F.col("original_value")).alias("email_metadata"),
    )


def demographic_identities(maids: DataFrame, emails: DataFrame) -> DataFrame:
    """Both ends of every row as (identity_id, type, metadata), each once."""
    empty = F.create_map().cast("map<string,string>")

    def one(identity_id: Column, kind: Column, metadata: Column) -> Column:
        return F.struct(identity_id.alias("identity_id"), kind.alias("type"), metadata.alias("metadata"))

    person = one(F.col("person_id"), F.lit(codes.PERSON_ID), empty)
    devices = maids.select(F.inline(F.array(person, one(F.col("native_maid"), F.col("maid_type"), empty))))
    contacts = emails.select(F.inline(F.array(person, one(F.col("hashed_email"), F.lit(codes.EMAIL), F.col("email_metadata")))))
    both = devices.unionByName(contacts).withColumn("_order", F.map_entries("metadata"))
    return first_per_key(both, ["identity_id", "type"], ["_order"]).drop("_order")


def demographic_identities_merge(stored: DataFrame, identities: DataFrame) -> DataFrame:
    return merge_insert_only(stored, identities, ["identity_id", "type"])


def demographic_edges(maids: DataFrame, emails: DataFrame, date: str) -> DataFrame:
    """Person to device and person to e-mail."""
    person = [F.col("person_id").alias("source"), F.lit(codes.PERSON_ID).alias("source_type")]
    devices = maids.select(*person, F.col("native_maid").alias("target"), F.col("maid_type").alias("target_type"))
    contacts = emails.select(*person, F.col("hashed_email").alias("target"), F.lit(codes.EMAIL).alias("target_type"))
    day = F.lit(date).cast("date")
    return devices.unionByName(contacts).distinct().select(
        *EDGE_KEY, F.lit(DEMOGRAPHIC_RELATED).alias("relationship"), F.lit(1).alias("frequency"),
        day.alias("created_date"), day.alias("last_seen_date"), F.lit(True).alias("active_flag"),
    )


def demographic_edges_merge(stored: DataFrame, edges: DataFrame) -> DataFrame:
    return merge_conditional(
        stored, edges, EDGE_KEY,
        update={
            "created_date": F.least("created_date", "s_created_date"),
            "last_seen_date": F.greatest("last_seen_date", "s_last_seen_date"),
        },
    )


# ---- customers ----------------------------------------------------------------------


def identity_components(identities: DataFrame, edges: DataFrame) -> DataFrame:
    """(qualified_identity, component_id) of the graph's active edges."""
    vertices = identities.select(qualified_identity(F.col("type"), F.col("identity_id")).alias("id"))
    active = edges.filter("active_flag").select(
        qualified_identity(F.col("source_type"), F.col("source")).alias("src"),
        qualified_identity(F.col("target_type"), F.col("target")).alias("dst"),
    )
    return connected_components(vertices, active).withColumnRenamed("id", "qualified_identity")


def customer360_expand(customer_360: DataFrame) -> DataFrame:
    """One row per identity of a customer, with the number of the customer's identities."""
    total = F.aggregate(F.map_values("identities"), F.lit(0), lambda acc, ids: acc + F.size(ids))
    typed = customer_360.select(
        "customer_360_id", "create_date", total.alias("num_identities"), F.explode("identities").alias("type", "ids")
    )
    return typed.select("customer_360_id", "create_date", "num_identities", "type", F.explode("ids").alias("id")).select(
        qualified_identity(F.col("type"), F.col("id")).alias("qualified_identity"), "customer_360_id", "num_identities", "create_date"
    )


def customer360_update(components: DataFrame, previous: DataFrame, today: str) -> DataFrame:
    """One active customer per component, keeping a previous id where the rule allows.

    A component takes over a previous customer when it holds more than half of that
    customer's identities: the oldest such customer, then the one with most identities, then
    the smallest id. Otherwise the id is a digest of the component's smallest identity, the
    previous owner of that identity and the day, so that a rerun gives the same id and a
    split-off part never gets the id it lost.
    """
    owned = customer360_expand(previous.filter("active_flag"))
    matched = components.join(owned, "qualified_identity")
    counts = matched.groupBy("component_id", "customer_360_id", "num_identities", "create_date").agg(
        F.count(F.lit(1)).alias("matched")
    )
    winners = counts.filter(F.col("matched") * 2 > F.col("num_identities")).groupBy("component_id").agg(
        F.min(F.struct("create_date", (-F.col("num_identities")).alias("size"), "customer_360_id")).alias("w")
    )
    owners = owned.groupBy(F.col("qualified_identity").alias("component_id")).agg(F.max("customer_360_id").alias("_owner"))
    by_type = components.groupBy("component_id", identity_type_of(F.col("qualified_identity")).alias("type")).agg(
        F.array_sort(F.collect_set(identity_id_of(F.col("qualified_identity")))).alias("ids")
    )
    people = by_type.groupBy("component_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "ids")))).alias("identities")
    )
    new_id = F.sha2(F.concat_ws("|", "component_id", F.coalesce("_owner", F.lit("")), F.lit(today)), 256)
    day = F.lit(today).cast("date")
    return (
        people.join(winners, "component_id", "left")
        .join(owners, "component_id", "left")
        .select(
            F.coalesce("w.customer_360_id", new_id).alias("customer_360_id"),
            "identities",
            F.coalesce("w.create_date", day).alias("create_date"),
            day.alias("update_date"),
            F.lit(True).alias("active_flag"),
        )
    )


def customer360_deactivate(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Current customers, and the previously active ones whose id was not reused as inactive."""
    lost = without_matches(previous.filter("active_flag"), current, ["customer_360_id"])
    return current.unionByName(lost.withColumn("active_flag", F.lit(False)).select(*current.columns))


def customer360_merge(stored: DataFrame, reconciled: DataFrame) -> DataFrame:
    return merge_partial_update(
        stored, reconciled.select(*stored.columns), ["customer_360_id"], ["identities", "update_date", "active_flag"]
    )
