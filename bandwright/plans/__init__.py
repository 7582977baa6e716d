from .batch import Outputs, derive, run_batch, write_outputs

__all__ = ["Outputs", "derive", "run_batch", "write_outputs"]
