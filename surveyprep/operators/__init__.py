"""DataFrame operators: codebook mapping, recode rules, reshape, keys,
zones, paths, weights, profiles and contracts."""
