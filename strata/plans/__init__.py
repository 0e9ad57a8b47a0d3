"""Layer plans: conform a raw batch, publish a conformed batch."""

from strata.plans.spec import EntitySpec  # noqa: F401
