"""What a model was fitted on: the names, the order and the types of its features.

The vector column itself tells: `assemble` notes names and types in its metadata, a fit takes the note
over to the model, and saving and loading keep it.
"""

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, NumericType

from scorekit.functions.names import VECTOR

_NOTE = "scorekit_features"


@dataclass(frozen=True)
class Contract:
    names: tuple[str, ...]
    types: tuple[str, ...]

    def to_json(self) -> str:
        return json.dumps({"names": self.names, "types": self.types})

    @classmethod
    def from_json(cls, text: str) -> "Contract":
        body = json.loads(text)
        return cls(tuple(body["names"]), tuple(body["types"]))


def note_features(df: DataFrame, flat: DataFrame, names: Sequence[str]) -> DataFrame:
    """`df`, whose vector column was assembled from columns of `flat`, with a note of what they are."""
    types = [flat.select(f"`{n}`").schema[0].dataType.simpleString() for n in names]
    known = df.schema[VECTOR].metadata or {}
    note = {"names": list(names), "types": types}
    return df.withMetadata(VECTOR, {**known, _NOTE: json.dumps(note)})


def contract_of(df: DataFrame) -> Contract | None:
    """What the vector column of `df` was assembled from, None if it does not tell."""
    if VECTOR not in df.columns:
        return None
    note = (df.schema[VECTOR].metadata or {}).get(_NOTE)
    return Contract.from_json(note) if note else None


def with_contract(model: PipelineModel, contract: Contract | None) -> PipelineModel:
    """`model`, which keeps the contract from now on."""
    model.scorekit_contract = contract
    return model


def contract_of_model(model: PipelineModel) -> Contract | None:
    return getattr(model, "scorekit_contract", None)


def check_features(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> None:
    """Raise unless the columns `features` of `df`, in that order, are what `model` was fitted on.

    Names are compared as the session compares them. A numeric type may be another than it was, as
    types that are inferred from files drift, but it must be one that holds numbers. Of a model without a
    contract only the number of its features is known.
    """
    contract = contract_of_model(model)
    if contract:
        same = str if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower
        if [same(n) for n in contract.names] != [same(n) for n in features]:
            raise ValueError(
                f"the model was fitted on {', '.join(contract.names)}, in this order; "
                f"the table is read as {', '.join(features)}"
            )
    else:
        size = getattr(model.stages[-1], "numFeatures", None)
        if size is not None and size >= 0 and size != len(features):
            raise ValueError(f"the model has {size} features, {len(features)} columns were given")
    for name in features:
        kind = df.select(f"`{name}`").schema[0].dataType
        was = dict(zip(contract.names, contract.types)).get(name) if contract else None
        if not isinstance(kind, (NumericType, BooleanType)) and kind.simpleString() != was:
            fitted = f", the model was fitted on {was}" if was else ""
            raise ValueError(f"column {name} is {kind.simpleString()}{fitted}")
