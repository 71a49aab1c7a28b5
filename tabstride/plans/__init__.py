from tabstride.plans.evaluation import error_report, evaluate, saved_error_report
from tabstride.plans.prepare import prepare, prepare_columns
from tabstride.plans.profile_report import profile_report
from tabstride.plans.scoring import score_batch
from tabstride.plans.training import evaluate_run, train_net

__all__ = [
    "error_report",
    "evaluate",
    "evaluate_run",
    "prepare",
    "prepare_columns",
    "profile_report",
    "saved_error_report",
    "score_batch",
    "train_net",
]
