FOLDER = "/root/testdata/sf0.01"
