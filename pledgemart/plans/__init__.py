"""Table transforms, marts, presentation datasets and the jobs that run them."""
