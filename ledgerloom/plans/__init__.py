"""Views, operational surfaces, warehouse refresh and the query catalogue."""
