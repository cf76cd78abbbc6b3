"""A labelled corpus from templates, one message per key, with label noise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.hashing import pick, uniform
from ticketloom.functions.text import fill_template

# Our own wording; the queues are those of the label mapping.
TEMPLATES: dict[str, list[str]] = {
    "account": ["please update the phone on my profile", "my login for {plan} stopped being accepted"],
    "billing": ["the {plan} bill shows {amount} more than agreed", "give back the {amount} taken on {day}"],
    "card_delivery": ["the card sent on {day} never reached me", "where is the parcel with my new card"],
    "general": ["which countries does {plan} cover", "what are the opening hours on {day}"],
    "technical": ["the page froze while paying {amount}", "every upload since {day} ends in an error"],
}
FILLERS: dict[str, list[str]] = {
    "amount": ["12 euro", "80 euro", "7 euro", "240 euro"],
    "plan": ["silver", "gold", "platinum"],
    "day": ["monday", "thursday", "sunday"],
}
LABELS = sorted(TEMPLATES)
NOISE = 0.10


def synthetic_corpus(keys: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """(key, text, label): every choice is a function of (seed, key).

    A tenth of the labels is redrawn over all queues, so one redraw in five keeps the
    label it had.
    """
    label = pick(LABELS, uniform(f"{seed}label", key))
    chosen = keys.select(key, label.alias("_label"))
    template = F.lit(None).cast("string")
    for name in LABELS:
        template = F.when(F.col("_label") == name, pick(TEMPLATES[name], uniform(f"{seed}text", key))).otherwise(template)
    fillers = {name: pick(values, uniform(f"{seed}{name}", key)) for name, values in FILLERS.items()}
    noisy = F.when(uniform(f"{seed}noise", key) < F.lit(NOISE), pick(LABELS, uniform(f"{seed}redraw", key)))
    return chosen.select(
        key, fill_template(template, fillers).alias("text"), F.coalesce(noisy, F.col("_label")).alias("label")
    )
