from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from scorekit.operators.contract import Contract, contract_of_model, with_contract
from scorekit.sources.files import beside, exists, put_in_place, read_small, remove, write_small

_CONTRACT = "feature_contract.json"


def save_model(model: PipelineModel, path: str) -> None:
    """Save a fitted pipeline, and what is known of its features, replacing what `path` holds.

    The model is written beside `path` and takes its place when it is whole, so that an older model can
    be loaded until then, also if this fails. Executors write parts of the model, so on a cluster `path`
    must lie on storage all of them share.
    """
    spark = SparkSession.active()
    staged = beside(path)
    try:
        model.write().save(staged)
        contract = contract_of_model(model)
        if contract:
            write_small(spark, f"{staged}/{_CONTRACT}", contract.to_json())
    except Exception:
        remove(spark, staged)
        raise
    put_in_place(spark, staged, path)


def load_model(path: str) -> PipelineModel:
    """A saved pipeline, with what was saved of its features; one saved elsewhere may have none."""
    model = PipelineModel.load(path)
    spark = SparkSession.active()
    file = f"{path.rstrip('/')}/{_CONTRACT}"
    if exists(spark, file):
        with_contract(model, Contract.from_json(read_small(spark, file)))
    return model
