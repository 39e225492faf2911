"""Jobs that combine operators: refresh, library facade, registered queries."""
