"""Users, their roles and their digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartlane.functions.text import digest
from cartlane.modes import REFERENCE, STRICT, check_mode
from cartlane.schemas import ROLE_ADMIN, ROLE_CUSTOMER, ROLE_MANAGER, ROLE_STAFF

# How many users each role takes before the next role is used.
ROLE_QUOTAS = {ROLE_ADMIN: 1, ROLE_MANAGER: 2, ROLE_STAFF: 4}


def users_with_role(users: DataFrame, role_user: DataFrame, roles: DataFrame, role_name: str) -> DataFrame:
    """The users that hold a role."""
    role = roles.filter(F.col("role_name") == role_name).select(F.col("id").alias("role_id"))
    holders = role_user.join(role, "role_id", "left_semi").select(F.col("user_id").alias("id"))
    return users.join(holders, "id", "left_semi")


def users_without(users: DataFrame, others: DataFrame) -> DataFrame:
    """The users that ``others.user_id`` does not name, however often it names the rest."""
    return users.join(others.select(F.col("user_id").alias("id")).distinct(), "id", "left_anti")


def role_counts(role_user: DataFrame, roles: DataFrame) -> DataFrame:
    """How many users hold each role, 0 for unused roles."""
    counted = role_user.groupBy("role_id").agg(F.count(F.lit(1)).alias("n"))
    return roles.join(counted, roles["id"] == counted["role_id"], "left").select(
        roles["id"].alias("role_id"), "role_name", F.coalesce("n", F.lit(0)).alias("user_count")
    )


def _first_open(counts: Column) -> Column:
    """The first role with a place left."""
    role = F.lit(ROLE_CUSTOMER)
    for name, quota in reversed(ROLE_QUOTAS.items()):
        role = F.when(counts[name] < quota, F.lit(name)).otherwise(role)
    return role


def _roles_of_batches(waiting: DataFrame, counts: Column, batch: str) -> DataFrame:
    """The batches that get another role than customer, and which.

    A batch gives its role to one user at least, so after as many batches as there are places
    none is left: only so many are looked at, in one fold over them.
    """
    places = sum(ROLE_QUOTAS.values())
    sizes = waiting.groupBy(batch).agg(F.count(F.lit(1)).alias("n")).orderBy(batch).limit(places)
    steps = sizes.agg(F.sort_array(F.collect_list(F.struct(F.col(batch).alias("batch"), "n"))).alias("steps"))
    steps = steps.select("steps", counts.alias("held"))
    kind = dict(waiting.dtypes)[batch]

    def step(so_far: Column, each: Column) -> Column:
        role = _first_open(so_far["held"])
        held = F.struct(*[(so_far["held"][r] + F.when(role == r, each["n"]).otherwise(F.lit(0))).alias(r) for r in ROLE_QUOTAS])
        given = F.concat(so_far["given"], F.array(F.struct(each["batch"].alias("batch"), role.alias("role"))))
        return F.struct(held.alias("held"), given.alias("given"))

    begin = F.struct("held", F.array().cast(f"array<struct<batch:{kind},role:string>>").alias("given"))
    found = steps.select(F.inline(F.aggregate("steps", begin, step)["given"]))
    return found.select(F.col("batch").alias(batch), F.col("role").alias("__role"))


def assign_roles(
    users: DataFrame, role_user: DataFrame, roles: DataFrame, mode: str = REFERENCE, batch: str | None = None
) -> DataFrame:
    """A role for each user that has none: ``user_id, role_id, role_name``.

    Reference mode reads the counts once, so a batch gets one role. Strict mode fills the
    places of each role in order of user id. There are few places, so only that many users
    are ranked; all others become customers without a global order.

    ``batch`` is a column with the number of each user's batch, for any number of batches at once:
    each sees the counts that the ones before it left. A user in several is of the first of them.
    """
    check_mode(mode)
    waiting = users_without(users, role_user).select(F.col("id").alias("user_id"), *([batch] if batch else []))
    if batch:
        waiting = waiting.groupBy("user_id").agg(F.min(batch).alias(batch))
    sequence = [batch, "user_id"] if batch else ["user_id"]
    names = roles.select(F.col("id").alias("role_id"), "role_name")
    held = F.struct(*[F.count_if(F.col("role_name") == r).alias(r) for r in ROLE_QUOTAS])
    counts = role_user.join(names, "role_id").agg(held.alias("held")).scalar()

    if mode == STRICT:
        places = sum(ROLE_QUOTAS.values())
        first = waiting.orderBy(*sequence).limit(places)
        ranked = first.withColumn("place", F.row_number().over(W.orderBy(*sequence)))
        filled, role = F.lit(0), F.lit(None).cast("string")
        bands = []
        for name, quota in ROLE_QUOTAS.items():
            filled = filled + F.greatest(F.lit(quota) - counts[name], F.lit(0))
            bands.append((name, filled))
        for name, upto in reversed(bands):
            role = F.when(F.col("place") <= upto, F.lit(name)).otherwise(role)
        # ``places`` rows at most.
        few = F.broadcast(ranked.select("user_id", role.alias("__role")))
        named = waiting.join(few, "user_id", "left").select(
            "user_id", F.coalesce("__role", F.lit(ROLE_CUSTOMER)).alias("role_name")
        )
    elif batch:
        # ``places`` rows at most.
        few = F.broadcast(_roles_of_batches(waiting, counts, batch))
        named = waiting.join(few, batch, "left").select("user_id", F.coalesce("__role", F.lit(ROLE_CUSTOMER)).alias("role_name"))
    else:
        named = waiting.select("user_id", _first_open(counts).alias("role_name"))
    # A role that the table lacks is an error, not a reason to lose its users.
    missing = F.raise_error(F.concat(F.lit("there is no role "), F.col("role_name"))).cast("bigint")
    found = named.join(names, "role_name", "left")
    return found.select("user_id", F.coalesce("role_id", missing).alias("role_id"), "role_name")


def ready_gate(addresses: DataFrame, role_user: DataFrame, roles: DataFrame) -> DataFrame:
    """One row: is there a customer with an address?"""
    role = roles.filter(F.col("role_name") == ROLE_CUSTOMER).select(F.col("id").alias("role_id"))
    holders = role_user.join(role, "role_id", "left_semi").select("user_id")
    found = addresses.join(holders, "user_id", "left_semi").limit(1)
    return found.agg((F.count(F.lit(1)) > 0).alias("ready"))


def with_digest(users: DataFrame, column: str = "password") -> DataFrame:
    """The column replaced by its digest."""
    return users.withColumn(column, digest(F.col(column)))
