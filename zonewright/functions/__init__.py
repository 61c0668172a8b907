"""Column functions: name policies, hashing, array kernels, features."""
