"""Values for the tasks, with the classes they are made of."""

from __future__ import annotations

import pickle
from typing import Any

from pyspark import Broadcast, SparkContext, cloudpickle


def send(context: SparkContext, value: Any) -> Broadcast:
    """Broadcast a value of this subpackage's classes.

    A plain broadcast names its classes, which executors without the package do
    not find; this one brings them along, like the functions.
    """
    return context.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast) -> Any:
    return pickle.loads(sent.value)
