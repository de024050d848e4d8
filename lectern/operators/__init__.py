"""DataFrame operators: projection, resolution, integrity, ordered logic, geometry, paging."""
