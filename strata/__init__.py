"""strata: layered data products (raw -> conformed -> serving) on Spark.

Every operator is a plain function over DataFrames built from built-in
Spark expressions; streaming jobs are ``foreachBatch`` wrappers around the
same functions.
"""

__version__ = "0.1.0"

from strata.operators.contract import (contract_report, enforce, infer_contract,  # noqa: E402,F401
                                       load_contract, parse_documents, save_contract)
from strata.operators.envelope import event_columns, land_events, split_envelope  # noqa: E402,F401
from strata.operators.flatten import (child_frames, drop_arrays, explode_child,  # noqa: E402,F401
                                      flatten_structs)
from strata.operators.latest import latest_per_key, split_null_keys  # noqa: E402,F401
from strata.operators.upsert import read_children, read_main  # noqa: E402,F401
from strata.plans.conform import conform, conformed_schema  # noqa: E402,F401
from strata.plans.publish import publish_entity  # noqa: E402,F401
from strata.plans.spec import EntitySpec  # noqa: E402,F401
