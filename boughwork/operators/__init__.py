"""DataFrame operators: filters, layout, comments and differences, parsing."""
