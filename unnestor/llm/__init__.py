"""Training-data operators: mixing, filtering, near-duplicate search, scoring
and token output. Nothing outside this package imports it; its queries are in
``unnestor.llm.queries`` and the document pipeline in ``corpus_pipeline``."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the workers whole, so a cluster needs no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
