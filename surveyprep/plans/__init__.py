"""Plans: the operator queries on the test tables and the eight survey dataset builders."""
