"""Alert rules as rows of a table instead of arguments: which parameters go to whom, and on which days.

A rule is (rule_id, parameters, recipients, first_day, last_day). Parameters and recipients are comma lists; NULL parameters are
all of them, NULL days are open ends. One plan serves all rules: the lists are exploded and joined to the alerts, so the
fact is read once however many rules there are, and each rule gets what a run of its own would give it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_trim
from .alerts import addressed_to, alert_messages

RULE = "rule_id"


def rule_parameters(rules: DataFrame) -> DataFrame:
    """(rule_id, wanted, first_day, last_day): a row per listed parameter, once each; NULL stands for all."""
    names = F.array_distinct(split_trim(F.col("parameters")))
    return rules.select(RULE, F.explode_outer(names).alias("wanted"), "first_day", "last_day").distinct()


def rule_recipients(rules: DataFrame) -> DataFrame:
    """(rule_id, recipient): a row per recipient, once each, without empty ones. A rule without any is refused when it is read."""
    names = F.filter(F.array_distinct(split_trim(F.col("recipients"))), lambda name: name != "")
    message = F.concat(F.lit("no recipients in rule "), F.col(RULE).cast("string"))
    missing = F.coalesce(F.size(names), F.lit(0)) < 1
    checked = F.when(missing, F.raise_error(message).cast("array<string>")).otherwise(names)
    return rules.select(RULE, F.explode(checked).alias("recipient")).distinct()


def alerts_of_rules(alerts: DataFrame, rules: DataFrame) -> DataFrame:
    """The alerts that each rule asks for: parameters by an equi-join, days by its bounds; rules for all parameters by the days alone."""
    wanted = rule_parameters(rules)
    day = F.col("measure_date")
    valid = (day >= F.coalesce("first_day", day)) & (day <= F.coalesce("last_day", day))
    named = alerts.join(wanted.where("wanted is not null"), (F.col("parameter_code") == F.col("wanted")) & valid)
    # rules for everything are few, and have no key: each is met through the days, of which it names a span
    spans = wanted.where("wanted is null")
    days = alerts.select("measure_date").distinct()
    own = spans.agg(F.collect_set(F.struct(RULE, "first_day", "last_day")).alias("spans"))
    dated = days.select("measure_date", F.explode(own.scalar()).alias("span"))
    dated = dated.where((day >= F.coalesce("span.first_day", day)) & (day <= F.coalesce("span.last_day", day)))
    every = alerts.join(dated.select("measure_date", f"span.{RULE}"), "measure_date")
    columns = [RULE, *alerts.columns]
    return named.select(columns).unionByName(every.select(columns)).dropDuplicates([RULE, "country_code", "measure_date", "parameter_code"])


def messages_of_rules(alerts: DataFrame, rules: DataFrame) -> DataFrame:
    """One message per rule, day, parameter and recipient, with the ``alert_id`` that a run of the rule alone gives it.

    A message is made once for a day and parameter, whatever rules ask for it.
    """
    asked = alerts_of_rules(alerts, rules).select(RULE, "measure_date", "parameter_code").distinct()
    messages = alert_messages(alerts)
    key = F.col("measure_date").eqNullSafe(F.col("_day")) & F.col("parameter_code").eqNullSafe(F.col("_parameter"))
    asked = asked.select(RULE, F.col("measure_date").alias("_day"), F.col("parameter_code").alias("_parameter"))
    sent = messages.join(asked, key).drop("_day", "_parameter").join(rule_recipients(rules), RULE)
    return addressed_to(sent)
