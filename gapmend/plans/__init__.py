from gapmend.plans.jobs import RepairMismatch, RepairReport, history, repair, validate

__all__ = ["RepairMismatch", "RepairReport", "history", "repair", "validate"]
