"""Passenger flow: tagged union -> recodes, fills, family and cabin features (FE16)
-> random forest AND logistic vote (ML17).

Shuffles: title medians (compacted counts), one aggregate per family key
(first position + the three family sums, joined back once), the global family
numbering, and one aggregate per cabin with the "UNK" sentinel left out
before the shuffle (it holds most rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import window as WN
from ..operators import prep as P
from ..operators.ids import exact_median, row_number_global

# fixed values: title word -> code, as in the reference flow
TITLE_CODES = {"Mr": 1, "Miss": 2, "Mrs": 3, "Master": 4, "Dr": 5, "Rev": 6, "Major": 7, "Col": 7,
               "Mlle": 8, "Mme": 8, "Don": 9, "Dona": 10, "Lady": 10, "Countess": 10,
               "Jonkheer": 10, "Sir": 9, "Capt": 7, "Ms": 2}

# fixed values: cabin deck letters -> code, as in the reference flow
DECK_CODES = {"UNK": 1, "C": 2, "B": 3, "D": 4, "E": 5, "A": 6, "F": 7, "G": 8, "T": 9}

# fixed values: predictor lists of the two voters (forest, logistic)
FOREST_PREDICTORS = ["Pclass", "Sex", "Age", "Fare", "Embarked", "FamilySize", "Title", "FamilyId",
                     "Married", "helpdummy"]
LOGISTIC_PREDICTORS = ["Pclass", "Sex", "Fare", "Parch", "SibSp", "Title", "Age", "Embarked", "FamilyId",
                       "FamilyWomen", "CabinLetter", "NameLength", "Married", "helpdummy"]

UNKNOWN_CABIN = "UNK"


def sex_code(c: str | Column = "Sex") -> Column:
    """PR18: male 0, female 1."""
    return P.recode_small(c, [("male", 0), ("female", 1)])


def embarked_code(c: str | Column = "Embarked") -> Column:
    """PR13 + PR18: NULL -> S; S 0, C 1, Q 2."""
    col = F.col(c) if isinstance(c, str) else c
    return P.recode_small(F.coalesce(col, F.lit("S")), [("S", 0), ("C", 1), ("Q", 2)])


def title_code(name: str | Column = "Name") -> Column:
    """SC2 + PR17: title word from the name, coded; unmatched -> 0."""
    return P.recode_map(S.regex_group(name), TITLE_CODES, 0)


def deck_code(cabin: str | Column = "Cabin") -> Column:
    """SC3 + PR17: leading capitals of the cabin, coded; unmatched -> 0."""
    return P.recode_map(S.regex_prefix(cabin), DECK_CODES, 0)


def passenger_features(p: DataFrame, order_train_first: bool = True) -> DataFrame:
    """FE16 on a passengers frame holding train and test rows (tag ``split``)."""
    base = p.withColumns({
        "Sex": sex_code("Sex").cast("double"),
        "Embarked": embarked_code("Embarked"),
        "FamilySize": F.col("SibSp") + F.col("Parch"),
        "NameLength": S.str_length("Name"),
        "_title_raw": S.regex_group("Name"),
        "Title": title_code("Name"),
        "_last": S.split_first("Name", ","),
        "Cabin": F.coalesce(F.col("Cabin"), F.lit(UNKNOWN_CABIN)),
        "Survived": F.coalesce(F.col("Survived"), F.lit(0)),
        "_ord": F.struct(F.when(F.col("split") == "train", 0).otherwise(1).alias("s"),
                         F.col("row_id").alias("r")),
    })
    base = base.withColumn("Married", F.col("Title").isin(1, 3).cast("int"))
    # Fare: NULL -> global median (train and test together, A14)
    base = P.fill_global_median(base, "Fare")
    # Age: NULL -> median of the title group; unmatched titles keep their own
    # group (the reference keeps the raw word as the key)
    base = base.withColumn("_tg", F.when(F.col("Title") == 0, F.concat(F.lit("?"), F.col("_title_raw")))
                           .otherwise(F.col("Title").cast("string")))
    med = exact_median(base, "Age", ["_tg"], "_agem")
    base = (base.join(med, "_tg", "left")
            .withColumn("Age", F.coalesce(F.col("Age"), F.col("_agem"))).drop("_agem", "_tg", "_title_raw"))
    base = base.withColumn("child", F.coalesce((F.col("Age") < 18).cast("int"), F.lit(0)))
    # family: one aggregate per (last name, size) -> first position and sums
    fam = base.groupBy("_last", "FamilySize").agg(
        F.min("_ord").alias("_first"),
        F.sum("Sex").alias("FamilyWomen"),
        F.sum("child").alias("FamilyChildren"),
        F.sum("Survived").alias("_famsurv"))
    fam = row_number_global(fam, ["_first"], "id").drop("_first")
    base = base.join(fam, ["_last", "FamilySize"], "left")
    base = base.withColumns({
        "FamilyId": F.when(F.col("FamilySize") < 3, F.lit(-1)).otherwise(F.col("id")),
        "FamilySurvive": F.col("_famsurv") - F.col("Survived"),
        "CabinLetter": deck_code("Cabin"),
    }).drop("_famsurv")
    # cabin survivors minus own, sentinel cabin -> 0 (WN5)
    base = WN.leave_one_out_sentinel(base, "Cabin", "Survived", "CabinSurvive", UNKNOWN_CABIN)
    helped = (F.col("FamilySurvive") > 0) | (F.col("CabinSurvive") > 0)
    base = base.withColumn("helpdummy", F.coalesce(
        (helped & ((F.col("Sex") == 1) | (F.col("Age") < 18))).cast("int"), F.lit(0)))
    return base.drop("_last", "_ord")


def _flow(p: DataFrame, num_trees: int, max_depth: int, lr_iter: int):
    """Train and test rows with both predictor vectors, and the two fits."""
    from ..operators import model as M

    # a title group with no known age keeps NULL ages in the feature table;
    # the models need a value, so those take the global median (PR14)
    feats = P.fill_global_median(passenger_features(p), "Age")
    feats = M.assemble(M.assemble(feats, FOREST_PREDICTORS, "f_rf"), LOGISTIC_PREDICTORS, "f_lr")
    feats = feats.withColumn("label", F.col("Survived").cast("double")).checkpoint()

    def rf(d):
        return M.random_forest("label", "f_rf", num_trees, 3, max_depth, key=["row_id"]).fit(d)

    def lr(d):
        return M.logistic(d.count(), "label", "f_lr", lr_iter).fit(d)  # C = 1: one over the rows fitted on

    return feats.where(F.col("split") == "train"), feats.where(F.col("split") == "test"), rf, lr


def flow_scores(p: DataFrame, num_trees: int = 150, max_depth: int = 30, lr_iter: int = 100,
                k: int = 3) -> DataFrame:
    """ML17 scores: (score, fold, accuracy): cross-validation of the forest, and the
    out-of-fold AND vote (fold -1).

    Folds: stratified contiguous (cross-validation) and contiguous in row order
    (vote), both numbered without a single-partition window.
    """
    from ..operators import ids as ID
    from ..operators import model as M
    from ..operators.metric import accuracy

    train, _, rf, lr = _flow(p, num_trees, max_depth, lr_iter)
    cv = M.cv_accuracy(ID.kfold_stratified(train, "label", ["row_id"], k, "fold"), "fold", k, rf, "label")
    oof = M.oof_scores(ID.kfold_contiguous(train, ["row_id"], k, "fold"), "row_id", "fold", k,
                       [("rf", rf), ("lr", lr)])
    wide = oof.groupBy("row_id").pivot("model", ["rf", "lr"]).agg(F.first("score"))
    vote = wide.select("row_id", S.vote_and("rf", "lr").cast("double").alias("prediction"))
    acc = accuracy(vote.join(train.select("row_id", "label"), "row_id"))
    return (cv.select(F.lit("cv_forest").alias("score"), "fold", "accuracy")
            .unionByName(acc.select(F.lit("oof_and_vote").alias("score"), F.lit(-1).alias("fold"), "accuracy")))


def run_flow(p: DataFrame, num_trees: int = 150, max_depth: int = 30, lr_iter: int = 100) -> DataFrame:
    """ML17: the submission (PassengerId, Survived), both models fitted on all training rows."""
    from ..operators import model as M

    train, test, rf, lr = _flow(p, num_trees, max_depth, lr_iter)
    s_rf = M.positive_proba(rf(train).transform(test), "probability", "s_rf").select("PassengerId", "f_lr", "s_rf")
    s_lr = M.positive_proba(lr(train).transform(s_rf), "probability", "s_lr")
    return s_lr.select("PassengerId", S.vote_and("s_rf", "s_lr").cast("int").alias("Survived"))
