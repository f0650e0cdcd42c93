"""Values, predicates and date ranges: what a query says, apart from how it runs."""
