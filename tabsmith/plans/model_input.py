"""Model-ready frame derived from the claims view.

preprocess -> encode target -> stratified split -> train-only fits (medians,
frequencies) -> engineered claim features.  Every fit reads the train split
only; the same transform is applied to every split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.dates import elapsed_days, weekend
from tabsmith.operators import encode, impute, split
from tabsmith.operators.features import claim_features
from tabsmith.plans.claims import claims
from tabsmith.session import spread, stored

TARGET = "claim_injury_type"
KEY = "claim_identifier"
FREQ = ["carrier_type", "county_of_injury", "industry_code"]
FEATURES = ["age_at_injury", "birth_year", "average_weekly_wage", "number_of_dependents", "ime_4_count",
            "Enc carrier_type", "Enc county_of_injury", "Enc industry_code", "days_to_c2", "accident_month",
            "Weekend_Accident", "Relative_Wage", "Age_Group", "Financial Impact Category"]


#: Columns of the claims view that the frame is made of.
NEEDED = [KEY, TARGET, "accident_date", "c_2_date", "age_at_injury", "birth_year", "average_weekly_wage", "number_of_dependents",
          "ime_4_count", *FREQ]


def model_frame(spark, sf) -> tuple[DataFrame, list[str], str, int]:
    # labels, cuts and fits each read the rows: the view's joins and the split are done once and written
    c = stored(claims(spark, sf).select(*NEEDED), "claims")
    labels = encode.fit_labels(c.select(TARGET), TARGET)
    n_classes = labels.count()
    d = encode.encode_labels(c, labels, TARGET).withColumn(TARGET, F.col(TARGET).cast("double"))
    d = stored(split.stratified_split(d, KEY, TARGET, 0.1, 0.2, 42), "split")
    train = d.where(F.col("split") == "train")
    meds = impute.fit_medians(train, ["age_at_injury", "average_weekly_wage"])
    d = impute.fill_from(d.withColumn("age_at_injury", F.col("age_at_injury").cast("double")), meds)
    d = impute.derive_birth_year(d, "birth_year", "accident_date", "age_at_injury")
    d = d.withColumn("birth_year", F.coalesce(F.col("birth_year").cast("double"), F.lit(-1.0)))
    d = impute.fill_constant(d, {"ime_4_count": 0.0})
    freq = encode.fit_frequency(train, FREQ)
    d = encode.frequency(d, freq, FREQ)
    d = d.withColumns({
        "days_to_c2": F.coalesce(elapsed_days("accident_date", "c_2_date"), F.lit(-1)).cast("double"),
        "accident_month": F.coalesce(F.month("accident_date"), F.lit(-1)).cast("double"),
        "Weekend_Accident": weekend("accident_date")})
    d = claim_features(d, "average_weekly_wage", meds["average_weekly_wage"], "age_at_injury",
                       dependents="number_of_dependents")
    d = d.withColumns({f: F.col(f"`{f}`").cast("double") for f in FEATURES})
    # fits read their input many times: written once, joins and fitted maps are not redone
    frame = stored(d.select(KEY, "split", TARGET, *[F.col(f"`{f}`") for f in FEATURES]), "model-frame")
    even = spread(frame)   # the files of a join come few and uneven
    return frame if even is frame else stored(even, "model-frame"), FEATURES, TARGET, n_classes
