"""Result tables, serving views and reports, composed from the operators."""
