"""Training-data operators over a ``documents`` table (doc_id, text, lang,
source, n_chars) and the registered queries that apply them.

Nothing else in the library imports this package. Task-side functions are
shipped by value (:func:`ship`), so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
