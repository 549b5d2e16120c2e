"""Jobs (section 3 of the survey) and the registered queries."""
