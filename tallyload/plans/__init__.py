"""Plans composed from the operators: the batch loader and the check catalog."""

from tallyload.plans.batch import BatchResult, Layout, load_tasks, run_batch

__all__ = ["BatchResult", "Layout", "load_tasks", "run_batch"]
