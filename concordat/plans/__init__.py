"""Plans that combine operators: load modes, audits, registered queries."""
